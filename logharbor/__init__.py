"""Batch and streaming jobs for security logs, written as Spark DataFrame functions."""

from logharbor.session import build_session, prepare, scratch_dir, work_dir

__all__ = ["build_session", "prepare", "scratch_dir", "work_dir"]
