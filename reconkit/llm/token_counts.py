"""Token counts of whole texts by compiled transducers.

The pre-tokenizer of a byte-level BPE file is compiled to a deterministic transducer
over character classes.  Texts are read as one stream in chunks: each chunk's map from
state to state is built for all states at once, four characters a step; a parallel
prefix scan composes the maps, which gives every chunk its real first state; a second
pass then marks where pre-tokens start.  A second transducer has one transition per
pre-token, annotated with the number of tokens it emits; it is compiled on demand, with
the library's own model, into a table of bounded size.
"""

from __future__ import annotations

import os
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from reconkit.llm.common import id_and_text, slices
from reconkit.llm.tokens import CACHE_PIECES, _LETTERS

CHUNK = 256  # characters whose state map is built in step
# classes of characters; END stands after each text
SPACE, BLANK, NUMBER, OTHER, QUOTE, LETTER, STMD, RV, E, L, END = range(11)
CLASSES = 11
# states: after a boundary, in letters, numbers, others, in one blank or a run of blanks
# (the last a space or not), and within a contraction ('  'r or 'v  'l)
START, LETTERS, NUMBERS, OTHERS, ONE_SPACE, ONE_BLANK, RUN_SPACE, RUN_BLANK, APOSTROPHE, HALF_RE, HALF_LL = range(11)
STATES = 11
HERE, BEFORE = 1, 2  # a pre-token starts at this character, at the one before


def _first(kind: int) -> tuple[int, int]:
    """A character that starts a pre-token."""
    state = {SPACE: ONE_SPACE, BLANK: ONE_BLANK, NUMBER: NUMBERS, OTHER: OTHERS, QUOTE: APOSTROPHE, END: START}
    return state.get(kind, LETTERS), 0 if kind == END else HERE


def _joined(kind: int) -> int:
    """State after a character that a space before it belongs to."""
    return {NUMBER: NUMBERS, OTHER: OTHERS, QUOTE: OTHERS}.get(kind, LETTERS)


def transition(state: int, kind: int) -> tuple[int, int]:
    """Next state and marks, for the pattern 's|'t|'re|'ve|'m|'ll|'d| ?letters| ?numbers| ?others|blanks(?!other)|blanks."""
    letter, blank = LETTER <= kind <= L, kind in (SPACE, BLANK)
    if kind == END:
        return START, BEFORE if state in (HALF_RE, HALF_LL) else 0
    if state == LETTERS and letter or state == NUMBERS and kind == NUMBER:
        return state, 0
    if state in (OTHERS, APOSTROPHE) and kind in (OTHER, QUOTE):
        return OTHERS, 0
    if state in (ONE_SPACE, ONE_BLANK, RUN_SPACE, RUN_BLANK) and blank:
        return (RUN_SPACE if kind == SPACE else RUN_BLANK), 0
    if state == ONE_SPACE:
        return _joined(kind), 0
    if state == RUN_SPACE:
        return _joined(kind), BEFORE
    if state == RUN_BLANK:
        return _first(kind)[0], BEFORE | HERE
    if state == APOSTROPHE and kind in (STMD, RV, L):
        return {STMD: START, RV: HALF_RE, L: HALF_LL}[kind], 0
    if state == HALF_RE and kind == E or state == HALF_LL and kind == L:
        return START, 0
    if state in (HALF_RE, HALF_LL):  # no contraction: the quote stood alone, the letter began a word
        return (LETTERS, BEFORE) if letter else (_first(kind)[0], BEFORE | HERE)
    return _first(kind)


def compiled() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Next state and marks by class * STATES + state, and next state after four classes."""
    both = np.array([[transition(s, c) for s in range(STATES)] for c in range(CLASSES)])
    step, marks = both[..., 0].astype(np.uint8), both[..., 1].astype(np.uint8)
    two = step[np.arange(CLASSES)[None, :, None], step[:, None, :]].reshape(CLASSES**2, STATES)
    four = two[np.arange(CLASSES**2)[None, :, None], two[:, None, :]]
    return step.ravel(), marks.ravel(), four.ravel()


@cache
def class_table() -> np.ndarray:
    """Class of each code point, as the library's own patterns see it."""
    from tokenizers import Regex, pre_tokenizers

    points = np.array([c for c in range(0x110000) if not 0xD800 <= c < 0xE000], np.uint32)
    every = points.astype("<u4").tobytes().decode("utf-32-le")
    table = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", BLANK)):
        for _, (a, b) in pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str(every):
            table[points[a:b]] = kind
    for kind, members in ((SPACE, " "), (QUOTE, "'"), (STMD, "stmd"), (RV, "rv"), (E, "e"), (L, "l")):
        table[[ord(c) for c in members]] = kind
    return table


class TokenCounter:
    def __init__(self, path: str, classes: np.ndarray | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        self.model = library.model
        self.specials = [t.content for t in library.get_added_tokens_decoder().values()]
        self.classes = class_table() if classes is None else classes
        self.step, self.marks, self.four = compiled()
        self.emitted: dict[str, int] = {}

    def starts(self, kinds: np.ndarray) -> np.ndarray:
        """Marks at each position of a stream of classes that begins after a boundary."""
        size = -(-len(kinds) // CHUNK) * CHUNK
        padded = np.full(size, END, np.uint8)
        padded[: len(kinds)] = kinds
        chunks = padded.reshape(-1, CHUNK).astype(np.int32)
        quads = chunks.reshape(len(chunks), -1, 4) @ np.array([CLASSES**3, CLASSES**2, CLASSES, 1], np.int32)
        maps = np.tile(np.arange(STATES, dtype=np.int32), (len(chunks), 1))
        for quad in np.ascontiguousarray(quads.T):
            maps = self.four.take(quad[:, None] * STATES + maps).astype(np.int32)
        reach = 1
        while reach < len(maps):  # inclusive prefix scan: map i becomes the composition of all up to i
            maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach], axis=1)
            reach *= 2
        state = np.concatenate([[START], maps[:-1, START]]).astype(np.int32)
        out = np.empty((CHUNK, len(chunks)), np.uint8)
        for i, kind in enumerate(np.ascontiguousarray(chunks.T)):
            at = kind * STATES + state
            out[i] = self.marks.take(at)
            state = self.step.take(at).astype(np.int32)
        return out.T.reshape(-1)[: len(kinds)]

    def _compile(self, pieces: set[str]) -> None:
        missing = [p for p in pieces if p not in self.emitted]
        if len(self.emitted) + len(missing) > CACHE_PIECES:
            self.emitted = {p: self.emitted[p] for p in pieces if p in self.emitted}
        run = self.model.tokenize
        for p in missing:
            self.emitted[p] = len(run(p.encode("utf-8").decode("latin-1").translate(_LETTERS)))

    def counts(self, texts: list[str]) -> np.ndarray:
        """Number of tokens of each text; strings of added tokens count one, as the library takes them."""
        parts, owner, extra = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            own = [text]
            for special in self.specials:
                if special in text:
                    own = [x for o in own for x in o.split(special)]
            extra[i] = len(own) - 1
            parts += own
            owner += [i] * len(own)
        stream = "\n".join(parts) + "\n"
        sizes = np.array([len(p) + 1 for p in parts], np.int64)
        ends = np.cumsum(sizes) - 1
        kinds = self.classes.take(np.frombuffer(stream.encode("utf-32-le", "surrogatepass"), "<u4"))
        kinds[ends] = END
        marks = self.starts(kinds)
        cut = (marks & HERE) > 0
        cut[:-1] |= (marks[1:] & BEFORE) > 0
        cut[ends] = True
        at = np.flatnonzero(cut)
        word = kinds[at[:-1]] != END
        first, last = at[:-1][word], at[1:][word]
        pieces = [stream[a:b] for a, b in zip(first.tolist(), last.tolist())]
        self._compile(set(pieces))
        emitted = np.fromiter(map(self.emitted.__getitem__, pieces), np.int64, len(pieces))
        total = np.concatenate([[0], np.cumsum(emitted)])
        upto = total[np.searchsorted(first, ends)]
        return np.bincount(owner, np.diff(upto, prepend=0), len(texts)).astype(np.int64) + extra


_COUNTERS: dict[str, TokenCounter] = {}


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row, from its whole text; null text is empty."""

    classes = docs.sparkSession.sparkContext.broadcast(class_table())  # a byte per code point

    def run(batches):
        if tokenizer not in _COUNTERS:
            _COUNTERS[tokenizer] = TokenCounter(tokenizer, classes.value)
        own = _COUNTERS[tokenizer]
        for part in slices(batches):
            size = pc.cast(pc.binary_length(part["text"]), pa.int64())
            yield pa.RecordBatch.from_arrays([part["doc_id"], size, pa.array(own.counts(part["text"].to_pylist()))], ["doc_id", "n_bytes", "n_tokens"])
        if len(own.emitted) > CACHE_PIECES // 2:
            own.emitted.clear()  # workers outlive their tasks

    counted = id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
