"""Token counts by finite-state transducers compiled from a byte-level BPE tokenizer's file.

Two transducers run one after the other. The first cuts a text where the tokenizer's pattern does: eleven states over
eleven classes of characters, whose transitions say where a stretch begins. Texts are cut in chunks of equal length;
each chunk's map from the state before it to the state after it is found for all states at once, the maps are composed
by a parallel prefix scan, and then every chunk runs from the state it is in. The second reads a stretch byte by byte;
its transitions carry the number of tokens that the byte adds (or takes away, where it completes a longer token). Its
states are compiled when a text first needs them.

Null texts count as empty, so they have no bytes and no tokens. Repeated rows, and rows with a null doc_id, are counted
each on its own. An empty table gives an empty result; other columns are left aside. A text of any length is taken in
pieces that end where a stretch does.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilotrace.llm.common import chunks, documents

#: Bytes of text taken at once.
PIECE = 4 << 20
#: Characters of a chunk of the prefix scan.
LENGTH = 512
#: States of the second transducer that a worker keeps; beyond, it starts anew. It bounds memory, not results.
STATES = 300_000

#: The first transducer's states. FRESH: a stretch begins with the next character.
FRESH, LETTERS, NUMBERS, SIGNS, APOSTROPHE, RE_VE, LL, SPACE, BLANK, SPACES, BLANKS = range(11)
#: Classes of characters. END stands between texts and for special tokens.
LETTER, ONE, R_V, L, E, NUMBER, SPACE_SIGN, BLANK_SIGN, APOSTROPHE_SIGN, SIGN, END = range(11)
#: Letters that stand apart, since the pattern has the endings 's 't 'm 'd 're 've 'll. Fixed values.
ENDINGS = {"s": ONE, "t": ONE, "m": ONE, "d": ONE, "r": R_V, "v": R_V, "l": L, "e": E}
#: The only pattern known here: that of byte-level tokenizers.
PRE_TOKENIZER = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def _opened(c: int) -> int:
    """The state after a stretch's first character."""
    if c <= E:
        return LETTERS
    return {NUMBER: NUMBERS, SPACE_SIGN: SPACE, BLANK_SIGN: BLANK, APOSTROPHE_SIGN: APOSTROPHE, SIGN: SIGNS, END: FRESH}[c]


def _step(state: int, c: int) -> tuple[int, bool, bool]:
    """(state after a character of class ``c``, whether a stretch begins with it, and with the one before it)."""
    blank, sign = c in (SPACE_SIGN, BLANK_SIGN), c in (APOSTROPHE_SIGN, SIGN)
    if c == END:
        return FRESH, False, state in (RE_VE, LL)
    if state in (LETTERS, NUMBERS, SIGNS):
        goes_on = {LETTERS: c <= E, NUMBERS: c == NUMBER, SIGNS: sign}[state]
        return (state, False, False) if goes_on else (_opened(c), True, False)
    if state == APOSTROPHE:
        ending = {ONE: FRESH, R_V: RE_VE, L: LL, APOSTROPHE_SIGN: SIGNS, SIGN: SIGNS}.get(c)
        return (_opened(c), True, False) if ending is None else (ending, False, False)
    if state in (RE_VE, LL):
        if c == (E if state == RE_VE else L):
            return FRESH, False, False
        return (LETTERS, False, True) if c <= E else (_opened(c), True, True)
    if state in (SPACE, BLANK, SPACES, BLANKS):
        many = state in (SPACES, BLANKS)
        if blank:
            return (SPACES if c == SPACE_SIGN else BLANKS), False, False
        if state in (SPACE, SPACES):  # the space goes with what follows
            return (LETTERS if c <= E else NUMBERS if c == NUMBER else SIGNS), False, many
        return _opened(c), True, many
    return _opened(c), True, False


#: next state and marks (1: begins here, 2: begins one before), by 16 * class + state.
NEXT, MARKS = np.zeros(16 * 11, np.uint8), np.zeros(16 * 11, np.uint8)
for _c in range(11):
    for _s in range(11):
        _to, _here, _before = _step(_s, _c)
        NEXT[16 * _c + _s], MARKS[16 * _c + _s] = _to, _here + 2 * _before


def composed(maps: np.ndarray) -> np.ndarray:
    """The state before each chunk when the first begins in FRESH; ``maps`` has a row of end states for each chunk.

    An inclusive scan: after step i a row is the composition of 2^i chunks that end with its own.
    """
    maps, reach = maps.copy(), 1
    while reach < len(maps):
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach], axis=1)
        reach *= 2
    return np.concatenate([[FRESH], maps[:-1, FRESH]]).astype(np.uint8)


def marked(classes: np.ndarray) -> np.ndarray:
    """Whether a stretch begins at each of the characters, given by their classes."""
    n = len(classes)
    lanes = -(-n // LENGTH)
    columns = np.full(lanes * LENGTH, END, np.uint8)
    columns[:n] = classes
    columns = np.ascontiguousarray(columns.reshape(lanes, LENGTH).T) * np.uint8(16)
    every = np.repeat(np.arange(11, dtype=np.uint8)[:, None], lanes, axis=1)
    for c in columns:
        every = NEXT[every + c]
    state, marks = composed(every.T), np.empty((LENGTH, lanes), np.uint8)
    for i, c in enumerate(columns):
        at = state + c
        state, marks[i] = NEXT[at], MARKS[at]
    marks = np.ascontiguousarray(marks.T).ravel()[:n]
    begins = (marks & 1).astype(bool)
    begins[:-1] |= marks[1:] >= 2
    return begins


def letters_of_bytes() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as: printable ones as they are, others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    """Counts tokens of stretches of bytes.

    What a byte does depends on the places behind it from which a token could still reach it: for each, the trie node
    of the bytes since and the token that ends there. A token is the last one of the bytes so far if no merge across
    the border to the token before it comes sooner than the merges within the two.
    """

    def __init__(self, model: dict):
        letters, vocabulary = letters_of_bytes(), model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        if len(vocabulary) != len(merges) + 256 or len({a + b for a, b in merges}) != len(merges):
            raise ValueError("the vocabulary must hold the 256 bytes and one token for each merge")
        self.merged = {(vocabulary[a], vocabulary[b]): rank for rank, (a, b) in enumerate(merges)}
        never, made = len(merges), {vocabulary[a + b]: (rank, vocabulary[a], vocabulary[b]) for rank, (a, b) in enumerate(merges)}
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for text, t in vocabulary.items():
            node = 0
            for ch in text:
                node = self.children[node].setdefault(letters[ch], len(self.token))
                if node == len(self.token):
                    self.children.append({})
                    self.token.append(-1)
            self.token[node] = t

        def spine(t: int, side: int) -> list[tuple[int, int]]:
            """The tokens at one end of ``t`` as it is merged, with the rank of the merge that takes each up."""
            out, until = [], never
            while True:
                out.append((t, until))
                if t not in made:
                    return out
                until, t = made[t][0], made[t][side]

        self.right = {t: spine(t, 2) for t in vocabulary.values()}
        self.left = {t: spine(t, 1) for t in vocabulary.values()}
        self.clear()

    def clear(self) -> None:
        self.fits: dict[tuple[int, int], bool] = {}
        start = ((0, -1, 0),)
        self.states, self.ids, self.moves = [start], {start: 0}, [{}]

    def follows(self, a: int, b: int) -> bool:
        """Whether token ``b`` can come after ``a``: no merge across the border is sooner than theirs.

        Of equal ranks the left merge is first: one that takes the left token's end comes before, others after.
        """
        known = self.fits.get((a, b))
        if known is None:
            known = True
            for x, x_until in self.right[a]:
                for y, y_until in self.left[b]:
                    rank = self.merged.get((x, y))
                    if rank is not None and rank < x_until and rank <= y_until:
                        known = False
            self.fits[a, b] = known
        return known

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        """The transition of a state by a byte: (next state, tokens added)."""
        after, last, added = [], -1, 0
        for node, before, count in self.states[state]:  # longest first
            node = self.children[node].get(byte)
            if node is None:
                continue
            t = self.token[node]
            if last < 0 <= t and (before < 0 or self.follows(before, t)):
                last, added = t, count + 1
            if self.children[node]:
                after.append((node, before, count))
        if last < 0:
            raise ValueError("the merges leave bytes without a token")
        to = (*((node, before, count - added) for node, before, count in after), (0, last, 0))
        place = self.ids.setdefault(to, len(self.states))
        if place == len(self.states):
            self.states.append(to)
            self.moves.append({})
        self.moves[state][byte] = place, added
        return place, added

    def count(self, stretch: bytes) -> int:
        state, total, moves = 0, 0, self.moves
        for byte in stretch:
            move = moves[state].get(byte)
            if move is None:
                if len(self.states) > STATES:  # anew, from where this stretch is
                    here = self.states[state]
                    self.clear()
                    moves, state = self.moves, self.ids.setdefault(here, 1)
                    if state:
                        self.states.append(here)
                        moves.append({})
                move = self.compile(state, byte)
            state = move[0]
            total += move[1]
        return total


class Counter:
    """Token counts of whole texts, many at a time."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        rule = data["pre_tokenizer"] or {}
        if {k: rule.get(k) for k in PRE_TOKENIZER} != PRE_TOKENIZER or data["normalizer"] or data["model"]["type"] != "BPE":
            raise ValueError(f"{path}: not a byte-level BPE tokenizer without normalizer and prefix space")
        self.special = [t["content"].encode() for t in data["added_tokens"]]
        if len(self.special) > 1 or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in data["added_tokens"]):
            raise ValueError(f"{path}: one special token at most, which takes up nothing around it")
        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.transducer = Transducer(data["model"])
        self.classes = np.full(0x110000, 255, np.uint8)  # 255: not met yet

    def _class(self, code: int) -> int:
        """The class of a character, as the tokenizer's own pattern treats it beside a letter, a number and a sign."""
        ch = chr(code)
        if ch in ENDINGS:
            return ENDINGS[ch]
        if ch in " '":
            return SPACE_SIGN if ch == " " else APOSTROPHE_SIGN
        for before, c in (("a", LETTER), ("1", NUMBER), ("!", SIGN)):
            if len(self.cut(before + ch)) == 1:
                return c
        return BLANK_SIGN

    def _begins(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The bytes where stretches begin, of texts one after the other, which end at ``bounds[1:]``."""
        starts = np.flatnonzero((raw & 0xC0) != 0x80)  # bytes of UTF-8 that begin a character
        codes = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), "<u4")
        classes = self.classes[codes]
        if len(new := np.unique(codes[classes == 255])):
            self.classes[new] = [self._class(c) for c in new.tolist()]
            classes = self.classes[codes]
        special, text = np.zeros(len(codes), bool), raw.tobytes() if self.special else b""
        for s in self.special:
            at = text.find(s)
            while at >= 0:
                owner = np.searchsorted(bounds, at, "right")
                if at + len(s) <= bounds[owner]:
                    first = np.searchsorted(starts, at)
                    classes[first : first + len(s.decode())] = END
                    special[first] = True
                at = text.find(s, at + (len(s) if at + len(s) <= bounds[owner] else 1))
        ends = np.searchsorted(starts, bounds)
        place = np.arange(len(codes)) + np.repeat(np.arange(len(bounds) - 1), np.diff(ends))
        padded = np.full(len(codes) + len(bounds) - 1, END, np.uint8)
        padded[place] = classes
        begins = (marked(padded)[place] | special) if len(codes) else special
        return starts[begins]

    def _counts(self, raw: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """The tokens of each stretch; distinct ones are counted once."""
        offsets = np.append(begins, len(raw)).astype(np.int64)
        stretches = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        coded = stretches.dictionary_encode()
        special, count = set(self.special), self.transducer.count
        each = np.array([1 if s in special else count(s) for s in coded.dictionary.to_pylist()], np.int64)
        return each[coded.indices.to_numpy()] if len(begins) else np.zeros(0, np.int64)

    def _long(self, text: bytes) -> int:
        """One text, piece by piece: each ends at the last stretch that what follows can't change."""
        back, at, size, total = 16 + sum(map(len, self.special)), 0, PIECE, 0
        while True:
            to = at + size
            while to < len(text) and text[to] & 0xC0 == 0x80:
                to += 1
            piece = np.frombuffer(text[at:to], np.uint8)
            begins = self._begins(piece, np.array([0, len(piece)]))
            if to >= len(text):
                return total + int(self._counts(piece, begins).sum())
            begins = begins[begins <= len(piece) - back]
            if len(begins) > 1:
                last = int(begins[-1])
                total += int(self._counts(piece[:last], begins[:-1]).sum())
                at, size = at + last, PIECE
            else:
                size *= 2

    def batch(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        out, bounds = np.zeros(len(texts), np.int64), np.concatenate([[0], np.cumsum(lengths)])
        if len(texts) == 1 and lengths[0] > PIECE:
            out[0] = self._long(texts[0].as_py().encode())
        elif bounds[-1]:
            first = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset]
            raw = np.frombuffer(texts.buffers()[2], np.uint8)[first : first + bounds[-1]]
            begins = self._begins(raw, bounds)
            before = np.concatenate([[0], np.cumsum(self._counts(raw, begins))])
            out = np.diff(before[np.searchsorted(begins, bounds)])
        return out


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One counter for all tasks of a worker."""
    return Counter(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document: bytes in UTF-8, tokens, and whether they are more
    than ``limit``. One pass over the texts, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(vocabulary)
        for batch in batches:
            for part in chunks(batch, 1, PIECE):
                tokens = own.batch(part.column(1))
                size = pc.fill_null(pc.binary_length(part.column(1)), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), size, pa.array(tokens), pa.array(tokens > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
