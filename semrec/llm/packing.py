"""Best-fit packing of tokenised documents into fixed-length sequences.

Documents become token pieces (only those longer than the capacity are cut);
each pack task streams its pieces through a bounded set of open bins.  A
bitset holds one bit per free space that some open bin has, so the best fit is
the lowest set bit at or above the piece's length; when too many bins are open
the fullest one closes.  Pieces arrive longest first, so small ones fill holes.

Only piece descriptions (about 50 bytes) are shuffled, never texts.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.taskcontext import TaskContext

from .common import frozen, python_ready, text_of

CAPACITY = 2048
OPEN_BINS = 8192
#: Full sequences of a pack task, at least.
TASK_SEQUENCES = 512
#: Words whose ids a worker remembers; beyond that it starts afresh.
CACHED_WORDS = 800_000
END_ID = 0
#: New words encoded in one call, and texts whose new words are gathered for it.
JOINED_WORDS, TEXTS_TOGETHER = 200, 300

_STOP = re.compile(r"[.,](?<=[^\W_].)(?=[ \n]|\Z)")


class WordEncoder:
    """Ids of whole texts as little-endian 32-bit bytes; the library sees each new word once.

    Valid for vocabularies that lower-case, drop white space and mark word ends:
    no token crosses a blank or line feed, so the ids of a text are those of its
    words in order.  Lower-casing first and setting a final stop or comma apart
    cannot change them either (checked per text where normalisation could), and
    make far fewer words.  Added tokens are matched in the raw text, so a text in
    which lower-casing would make one is left as it is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ends_word = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}

    def words(self, text: str) -> list[str]:
        low = text.lower()
        if any(t in low and low.count(t) != text.count(t) for t in self.added):
            pass  # another spelling of an added token
        elif low.isascii() or "\u03a3" not in text and unicodedata.is_normalized(
                "NFC", text) and unicodedata.is_normalized("NFC", low):
            text = _STOP.sub(r" \g<0>", low)
        return text.replace("\n", " ").split(" ")

    def _learn(self, new: list[str]) -> None:
        plain = [w for w in new if w.isalpha()]
        other = [w for w in new if not w.isalpha()]
        groups = [plain[i:i + JOINED_WORDS] for i in range(0, len(plain), JOINED_WORDS)]
        made = self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        for group, e in zip(groups, made):
            ids = np.array(e.ids, dtype="<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(group):  # a letter that the library splits at
                other += group
                continue
            raw, at = ids.tobytes(), 0
            for w, end in zip(group, (4 * ends).tolist()):
                self.known[w] = raw[at:end]
                at = end
        for w, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            self.known[w] = array("I", e.ids).tobytes()

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        for i in range(0, len(texts), TEXTS_TOGETHER):
            split = [self.words(t) for t in texts[i:i + TEXTS_TOGETHER]]
            if len(self.known) > CACHED_WORDS:
                self.known = {"": b""}
            known = self.known
            new = set().union(*split).difference(known)
            if new:
                self._learn(sorted(new))
            for words in split:
                yield b"".join([known[w] for w in words])


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY,
                 id_col: str = "doc_id", text_col: str = "text",
                 with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, salt[, ids]``.

    A document is its tokens followed by the id 0; a null text is empty and
    gives the one id 0.  A document over ``capacity`` tokens is cut into pieces
    of ``capacity``, the last may be shorter.  ``ids`` are little-endian 32-bit
    bytes.  ``salt`` counts rows inside the task, so equal rows can be spread.
    Other columns are not carried; repeated rows stay.
    """
    made = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
            ("salt", pa.int32())] + [("ids", pa.binary())] * with_ids
    kinds = {pa.int32(): T.IntegerType(), pa.int64(): T.LongType(), pa.binary(): T.BinaryType()}
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           *(T.StructField(n, kinds[t]) for n, t in made)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, n, step = _encoder(vocabulary), TaskContext.get().partitionId() * 7919, 4 * capacity
        end = END_ID.to_bytes(4, "little")
        for b in batches:
            rows, out = [], []
            for i, ids in enumerate(encoder.encode_all(b.column(1).to_pylist())):
                ids += end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    n += 1
                    rows.append(i)
                    out.append((k, at // 4, len(part) // 4, zlib.crc32(part), n % 1024, part))
            cells = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(  # ids of documents never leave Arrow
                [b.column(0).take(pa.array(rows, pa.int32())),
                 *(pa.array(c, t) for c, (_, t) in zip(cells, made))], names=schema.names)

    return (python_ready(docs).select(F.col(f"`{id_col}`"), text_of(text_col).alias("__text"))
            .mapInArrow(cut, schema))


class BestFit:
    """Bounded-space best fit over bins of ``capacity``."""

    def __init__(self, capacity: int, open_bins: int, first_bin: int = 0, stride: int = 1):
        self.capacity, self.limit, self.stride = capacity, open_bins, stride
        self.next_bin, self.bits, self.n_open = first_bin, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece of 1 .. capacity tokens."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            bins = self.by_free[free]
            at = bins.pop()
            if not bins:
                self.bits &= ~(1 << free)
            self.n_open -= 1
        else:
            free, at = self.capacity, self.next_bin
            self.next_bin += self.stride
        left = free - length
        if left:
            if not self.by_free[left]:
                self.bits |= 1 << left
            self.by_free[left].append(at)
            self.n_open += 1
            if self.n_open > self.limit:  # the fullest closes
                tight = (self.bits & -self.bits).bit_length() - 1
                self.by_free[tight].pop()
                if not self.by_free[tight]:
                    self.bits &= ~(1 << tight)
                self.n_open -= 1
        return at, self.capacity - free


def pack_tasks(pieces: DataFrame, capacity: int = CAPACITY) -> int:
    """Tasks to pack in: as many as the session shuffles over, but none with fewer than about ``TASK_SEQUENCES``
    full sequences, as every task leaves some bins unfilled."""
    total = pieces.agg(F.sum("length")).first()[0] or 0
    most = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(most, total // (capacity * TASK_SEQUENCES)))


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS,
         tasks: int | None = None) -> DataFrame:
    """``pieces`` plus ``sequence_id`` and ``offset`` (gapless from 0 per sequence).

    ``pieces`` needs ``length`` (1 .. capacity), ``ids_crc32`` and ``salt``.  Each
    task packs an evenly dealt share; without ``tasks`` their number follows from the tokens
    (:func:`pack_tasks`; ``pieces`` is read twice then).  Input columns named ``sequence_id`` or ``offset``
    are replaced.  An empty frame gives an empty one.
    """
    pieces = pieces.drop("sequence_id", "offset")
    tasks = tasks or pack_tasks(pieces, capacity)
    names = pieces.columns
    order = [F.col("length").desc()] + [F.col(f"`{c}`") for c in names if c != "length"]
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, length = BestFit(capacity, open_bins, TaskContext.get().partitionId() << 32), names.index("length")
        for b in batches:
            spots = [packer.place(n) for n in b.column(length).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([s for s, _ in spots], pa.int64()), pa.array([o for _, o in spots], pa.int64())],
                names=schema.names)

    # pieces of one task in a fixed order: a recomputed task packs alike
    dealt = (python_ready(pieces).repartition(tasks, "ids_crc32", "salt")
             .sortWithinPartitions(*order))
    return dealt.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY,
                   open_bins: int = OPEN_BINS, id_col: str = "doc_id", text_col: str = "text",
                   with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack every document; see :func:`token_pieces` and :func:`pack`.  Pieces are written once,
    so no text is encoded again to count them.  Texts of any length are encoded whole; an empty or null
    text is one piece of one token; columns other than id and text are left out, whatever their names."""
    pieces = frozen(token_pieces(docs, vocabulary, capacity, id_col, text_col, with_ids))
    return pack(pieces, capacity, open_bins).drop("salt")
