"""BPE encoding by dynamic programming over prefixes, and decoding.

Every prefix of a word has exactly one last token in its encoding. A suffix automaton of the
vocabulary yields the tokens that end at a position; the one that may follow the last token of the
prefix before it is stored, and the encoding is read off the stored tokens from the end.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
from array import array
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logharbor.llm.common import arrow_column, whole_text

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Words and token pairs whose answer a worker keeps; beyond that it starts over.
KEPT_WORDS, KEPT_PAIRS, KEPT_WORD_CHARS = 400_000, 500_000, 48
NEVER = 1 << 60


class SuffixAutomaton:
    """All substrings of a set of sequences; `token[s]` is the sequence that state s stands for, if any."""

    def __init__(self, sequences: dict[int, list[int]]):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length, self.token = [-1], [0], [-1]
        for number, sequence in sequences.items():
            last = 0
            for symbol in sequence:
                last = self._extend(last, symbol)
            self.token[last] = number
        #: The longest proper suffix of a state that is a whole sequence.
        self.shorter = [-1] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            up = self.link[state]
            self.shorter[state] = up if self.token[up] >= 0 else self.shorter[up]

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.token.append(-1)
        return len(self.link) - 1

    def _split(self, at: int, symbol: int, target: int) -> int:
        """A copy of `target` for the strings that `at` reaches it by."""
        copy = self._state(self.length[at] + 1, self.link[target], dict(self.step[target]))
        self.link[target] = copy
        while at >= 0 and self.step[at].get(symbol) == target:
            self.step[at][symbol] = copy
            at = self.link[at]
        return copy

    def _extend(self, last: int, symbol: int) -> int:
        known = self.step[last].get(symbol)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, symbol, known)
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and symbol not in self.step[at]:
            self.step[at][symbol] = new
            at = self.link[at]
        if at >= 0:
            target = self.step[at][symbol]
            exact = self.length[target] == self.length[at] + 1
            self.link[new] = target if exact else self._split(at, symbol, target)
        return new


class Bpe:
    """The tables of one tokenizer file and the encoder over them."""

    def __init__(self, spec: str):
        model = json.loads(spec)
        self.spec = spec
        self.specials = {t["content"]: t["id"] for t in model["added_tokens"]}
        ids: dict[str, int] = model["model"]["vocab"]
        self.end = model["model"]["end_of_word_suffix"]
        self.size = max([*ids.values(), *self.specials.values()]) + 1
        self.names: list[str | None] = [None] * self.size
        for name, number in [*ids.items(), *self.specials.items()]:
            self.names[number] = name
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(model["model"]["merges"]):
            left, right = (ids[p] for p in (pair if isinstance(pair, list) else pair.split(" ")))
            made = ids[self.names[left] + self.names[right]]
            if made in self.rank:
                raise ValueError("the encoder needs vocabularies with one merge per token")
            self.parts[made], self.rank[made], self.merge[left, right] = (left, right), rank, rank
        base = [number for number in ids.values() if number not in self.parts]
        symbols: dict[int, list[int]] = {number: [number] for number in base}
        self.tails: dict[int, list[tuple[int, int]]] = {}
        self.heads: dict[int, list[tuple[int, int]]] = {}
        for made, (left, right) in self.parts.items():
            # a token counts only if its own text is encoded as that one token
            if left in symbols and right in symbols and self._apart(left, right, self.rank[made]):
                symbols[made] = symbols[left] + symbols[right]
        self.tails.clear()
        self.heads.clear()
        self.automaton = SuffixAutomaton(symbols)
        self.pairs: dict[tuple[int, int], bool] = {}
        names = byte_names()
        #: The token of a byte inside a word, and at its end.
        self.inner, self.closing = [ids[n] for n in names], [ids[n + self.end] for n in names]
        self.bytes = {name: b for b, name in enumerate(names)}
        self.words = Words(self)
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")")

    def _edge(self, token: int, side: int, kept: dict[int, list[tuple[int, int]]]) -> list[tuple[int, int]]:
        """The pieces that lie at one end of a token while it is built: piece, rank of the merge that ends it."""
        if token not in kept:
            piece, ends, chain = token, NEVER, []
            while True:
                chain.append((piece, ends))
                if piece not in self.parts:
                    break
                ends, piece = self.rank[piece], self.parts[piece][side]
            kept[token] = chain[::-1]
        return kept[token]

    def _apart(self, left: int, right: int, before: int = NEVER) -> bool:
        """True if no merge of a rank below `before` joins the tokens across their border.

        At any time one piece lies on either side. Their merge is applied if it comes before the left
        piece is merged away, and not after the right one is: of equal merges the left one is first.
        """
        tail, head = self._edge(left, 1, self.tails), self._edge(right, 0, self.heads)
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = tail[i], head[j]
            rank = self.merge.get((a, b))
            if rank is not None and rank < a_ends and rank <= b_ends and rank < before:
                return False
            if a_ends <= b_ends:
                if a_ends == NEVER:
                    return True
                i += 1
            else:
                j += 1

    def follows(self, left: int, right: int) -> bool:
        answer = self.pairs.get((left, right))
        if answer is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            answer = self.pairs[left, right] = self._apart(left, right)
        return answer

    @cached_property
    def library(self) -> Tokenizer:
        """The file's own rules, for texts in scripts other than Latin."""
        return Tokenizer.from_str(self.spec)

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        sam, known = self.automaton, self.pairs
        step, link, length, tokens, shorter = sam.step, sam.link, sam.length, sam.token, sam.shorter
        symbols = [self.inner[b] for b in word[:-1]]
        symbols.append(self.closing[word[-1]])
        last, start = [-1], [0]
        state = matched = 0
        for at, symbol in enumerate(symbols, 1):
            edges = step[state]
            while symbol not in edges:
                state = link[state]
                matched, edges = length[state], step[state]
            state, matched = edges[symbol], matched + 1
            found = state if tokens[state] >= 0 and length[state] == matched else shorter[state]
            begin = at - length[found]
            while begin:
                pair = (last[begin], tokens[found])
                if known[pair] if pair in known else self.follows(*pair):
                    break
                found = shorter[found]
                begin = at - length[found]
            last.append(tokens[found])
            start.append(begin)
        ids, at = [], len(symbols)
        while at:
            ids.append(last[at])
            at = start[at]
        return ids[::-1]

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as packed 32-bit integers."""
        if "<" not in text or not (pieces := self.special.split(text))[1:]:
            return self._encode_piece(text)
        out = []
        for number, piece in enumerate(pieces):
            out.append(struct.pack("i", self.specials[piece]) if number % 2 else self._encode_piece(piece))
        return b"".join(out)

    def _encode_piece(self, text: str) -> bytes:
        if text.isascii():
            return b"".join(map(self.words.__getitem__, ASCII_WORD.findall(text.lower())))
        if not NOT_LATIN.search(text):
            return b"".join(map(self.words.__getitem__, LATIN_WORD.findall(unicodedata.normalize("NFC", text).lower())))
        # other scripts: character classes depend on the Unicode version, so the file's own rules are asked
        words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return b"".join(self.words[bytes(map(self.bytes.__getitem__, name)).decode(errors="surrogateescape")] for name, _ in words)


class Words(dict):
    """Packed ids by word; a word is encoded when it is first met.

    Half of the words that are kept are the latest, the other half those before them: a word that is met
    again moves to the latest, so common words stay.
    """

    def __init__(self, bpe: Bpe):
        super().__init__()
        self.bpe, self.before = bpe, {}

    def __missing__(self, word: str) -> bytes:
        packed = self.before.get(word)
        if packed is None:
            packed = array("i", self.bpe.encode_word(word.encode(errors="surrogateescape"))).tobytes()
        if len(word) <= KEPT_WORD_CHARS:
            if 2 * len(self) >= KEPT_WORDS:
                self.before = dict(self)
                self.clear()
            self[word] = packed
        return packed


def _of_category(*starts: str) -> str:
    """The Latin characters of some Unicode categories, for use inside a character class."""
    return "".join(re.escape(c) for c in map(chr, range(0x250)) if unicodedata.category(c)[0] in starts)


#: The split pattern of the file for lower-case ASCII and for Latin texts, whose categories no Unicode version changes.
ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t\n\r\f\va-z0-9]+")
NOT_LATIN = re.compile("[^\x00-\u024f]")
LATIN_WORD = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_of_category('L')}]+|[{_of_category('N')}]|[^ \t\n\r\f\v\x85\xa0{_of_category('L', 'N')}]+"
)


def byte_names() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in shown}
    for number, b in enumerate(b for b in range(256) if b not in names):
        names[b] = chr(256 + number)
    return [names[b] for b in range(256)]


_LOADED: dict[str, Bpe] = {}


def loaded(spec: str) -> Bpe:
    """The tables of a tokenizer file, built once in each worker."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Bpe(spec)
    return _LOADED[key]


def _shipped(df: DataFrame, tokenizer: str):
    """The tokenizer file, read on the driver and sent to the workers; it has a few MB whatever the input."""
    with open(tokenizer, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def packed_ids(bpe: Bpe, texts: pa.Array) -> pa.ListArray:
    packed = [bpe.encode(text) for text in texts.to_pylist()]
    offsets = np.cumsum([0, *map(len, packed)]) // 4
    ids = pa.array(np.frombuffer(b"".join(packed), np.int32))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), ids)


def spelled(names: list[str | None], lists: pa.ListArray) -> pa.StringArray:
    ids, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    known = pc.and_(pc.greater_equal(ids, 0), pc.less(ids, len(names)))
    named = pc.take(pa.array(names), pc.if_else(known, ids, None))
    offsets -= offsets[0]
    if named.null_count:
        offsets = np.concatenate([[0], np.cumsum(named.is_valid().to_numpy(zero_copy_only=False))])[offsets]
        named = named.drop_null()
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), named), " ")


def encode(
    df: DataFrame, text_col: str = "text", out: str = "token_ids", tokenizer: str = TOKENIZER, decoded: str | None = None
) -> DataFrame:
    """The table with the ids of each whole text in a new column; null and empty texts have no ids.

    With `decoded`, the same pass decodes the ids into a column of that name. Rows are encoded one by
    one, so repeated rows and ties do not matter; an empty table stays empty. Other columns are passed
    on; one that is named like a new one is replaced. Texts are normalised and split as the tokenizer
    file says, and special tokens written out in a text become their ids.
    """
    spec = _shipped(df, tokenizer)
    if decoded is None:
        return df.withColumn(out, arrow_column(lambda texts: packed_ids(loaded(spec.value), texts), "array<int>")(whole_text(text_col)))

    def both(texts: pa.Array) -> pa.Array:
        ids = packed_ids(loaded(spec.value), texts)
        return pa.StructArray.from_arrays([ids, spelled(vocabulary(spec.value), ids)], ["ids", "decoded"])

    coded = df.withColumn("__coded", arrow_column(both, "struct<ids: array<int>, decoded: string>")(whole_text(text_col)))
    return coded.withColumns({out: F.col("__coded.ids"), decoded: F.col("__coded.decoded")}).drop("__coded")


def decode(df: DataFrame, ids_col: str = "token_ids", out: str = "decoded", tokenizer: str = TOKENIZER) -> DataFrame:
    """The table with the text of each list of ids, special tokens included.

    The file names no decoder, so token texts are joined by single spaces. Ids outside the vocabulary
    are left out; null and empty lists give an empty text. A column named `out` is replaced.
    """
    spec = _shipped(df, tokenizer)
    lists = F.coalesce(F.col(f"`{ids_col}`"), F.array().cast("array<int>"))
    return df.withColumn(out, arrow_column(lambda ids: spelled(vocabulary(spec.value), ids), "string")(lists))


_NAMES: dict[str, list[str | None]] = {}


def vocabulary(spec: str) -> list[str | None]:
    """Token texts by id."""
    if spec not in _NAMES:
        model = json.loads(spec)
        ids = model["model"]["vocab"] | {t["content"]: t["id"] for t in model["added_tokens"]}
        names: list[str | None] = [None] * (max(ids.values()) + 1)
        for name, number in ids.items():
            names[number] = name
        _NAMES.clear()
        _NAMES[spec] = names
    return _NAMES[spec]


def digest_rows(docs: DataFrame) -> DataFrame:
    texts = docs.select("doc_id", whole_text("text").alias("text"))
    coded = encode(texts, decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
