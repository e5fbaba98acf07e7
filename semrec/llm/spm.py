"""SentencePiece BPE encoding and decoding as a max-plus parallel scan.

A BPE encoding is the one path through the lattice of pieces on which every two
neighbouring pieces encode to themselves when joined, so it is the best path of a
max-plus system whose arcs weigh 0 (the two pieces may stand together) or minus
infinity.  Giant texts are cut into chunks.  A cut's states are the pieces that
could lie across or end at it; each chunk yields the transfer matrix from the
states of its left cut to those of its right cut, the matrices combine
associatively, and with its two states known each chunk is traced back alone.

No piece crosses certain places (before a blank, around unknown characters), so
inside a chunk the lattice splits into short units whose paths are remembered,
and a matrix is the outer sum of its head's and tail's scores unless the whole
chunk is one unbroken run.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from math import nextafter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import sized_broadcast
from .common import frozen, python_ready, text_of

BLANK = "▁"
#: Set before a stop that becomes a word of its own (private use; texts that hold it go the general way).
MARK = "\ue000"
#: Characters of a chunk; longer texts are scanned in parallel.
CHUNK = 32_768
CACHED_UNITS, CACHED_PAIRS = 350_000, 400_000
#: Rows handed on together, so a worker never holds a whole batch in several forms.
ROWS_TOGETHER = 400
NEVER = -np.inf

State = tuple[int, int]  # (start, end) of a piece, relative to its cut


class Pieces:
    """Vocabulary and merge rules of a SentencePiece BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.score: dict[str, float] = {}
        self.ident: dict[str, int] = {}
        self.byte_id = [0] * 256
        self.short = n <= 1 << 16  # ids fit into two bytes
        self.surface: list[bytes] = []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_id[value] = i
                self.surface.append(bytes([value]))
            elif model.is_control(i):
                self.surface.append(b"")
            elif model.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            else:
                self.score[piece], self.ident[piece] = model.get_score(i), i
                self.surface.append(piece.replace(BLANK, " ").encode("utf-8"))
        self.longest = max(map(len, self.score))
        self.openings = {p[:k] for p in self.score for k in range(1, len(p))}  # may go on to a piece
        # stops that no piece has right behind a letter can be units of their own
        inner = [c for c in ".," if not any(re.search(r"[^\W\d_]" + re.escape(c), p) for p in self.score)]
        self.stop = re.compile(f"[{''.join(inner)}](?<=[^\\W\\d_].)(?=[ \\n]|\\Z)") if inner else None
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.score):
            raise ValueError("pieces with a blank inside are not supported")
        self.run = re.compile(f"{BLANK}*[^{BLANK}\\n]+|{BLANK}+|\\n")
        self.pairs: dict[int, bool] = {}
        self.made: dict[str, tuple[float, str, str] | None] = {}
        self.runs: dict[str, bytes] = {"": b""}  # stretches as they are
        self.words: dict[str, bytes] = {}  # stretches behind a blank, without it

    def merged(self, text: str, until: int = 1) -> list[str]:
        """Pieces of a short string by the merge rule: best score first, then leftmost;
        merging stops when ``until`` are left."""
        parts = list(text)
        while len(parts) > until:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _made(self, piece: str) -> tuple[float, str, str] | None:
        """(rank of its last merge, left, right) of a piece that merges to itself; a single
        character has rank -1; None for a piece that merging its characters never gives."""
        got = self.made.get(piece, 0)
        if got == 0:
            parts = self.merged(piece, 2)
            got = (-1.0, piece, piece) if len(piece) == 1 else (
                (-self.score[piece], *parts) if len(parts) == 2 and piece in self.score
                and self.merged(piece) == [piece] else None)
            self.made[piece] = got
        return got

    def together(self, left: str, right: str) -> bool:
        """Whether the two pieces stand next to each other unmerged.

        Merges are undone from the latest back; the pieces stand if no pair across
        their border would have been merged before the merge just undone.
        """
        if not left:
            return self._made(right) is not None
        i, j = self.ident.get(left), self.ident.get(right)
        if i is None or j is None:  # a character that no piece has merges with nothing
            return self._made(left) is not None and self._made(right) is not None
        key = i * len(self.surface) + j
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) > CACHED_PAIRS:
                self.pairs.clear()
            got = self.pairs[key] = self._stand(left, right)
        return got

    def _stand(self, left: str, right: str) -> bool:
        if left[-1] == BLANK and right[0] == BLANK:  # scores of runs of blanks are all equal
            return self.merged(left + right) == [left, right]
        a, b = self._made(left), self._made(right)
        if a is None or b is None:
            return False
        x, y, limit = left, right, float("inf")
        while True:
            s = self.score.get(x + y)
            if s is not None and -s < limit:
                return False
            if a[0] > b[0]:
                limit, x = a[0], a[2]
                a = self._made(x)
            elif b[0] >= 0:
                limit, y = nextafter(b[0], float("inf")), b[1]  # an equal one further left comes first
                b = self._made(y)
            else:
                return True

    def path(self, text: str, before: str = "") -> list[list[str]] | None:
        """For every end i the last piece of the best path that covers ``text[:i]`` behind the
        piece ``before``, as ``(piece,)`` lists; empty where no path ends."""
        n, score, longest = len(text), self.score, self.longest
        last: list[list[str]] = [[] for _ in range(n + 1)]
        last[0] = [before]
        for i in range(1, n + 1):
            for start in range(max(0, i - longest), i):
                piece = text[start:i]
                if (piece in score or start == i - 1) and last[start] and \
                        self.together(last[start][0], piece):
                    last[i] = [piece]
                    break
        return last

    def unit(self, text: str) -> list[str]:
        """Pieces of a unit: the one complete path, found depth first with long pieces first.

        A prefix has only one path, so a place from which no path went on is dead for good.
        """
        score, openings, n = self.score, self.openings, len(text)
        if text in score and self.together("", text):
            return [text]
        out, choices, at, dead = [], [], 0, set()
        while at < n:
            if len(choices) == len(out):
                end, found = at + 1, [text[at]]
                while end < n:
                    end += 1
                    piece = text[at:end]
                    if piece in score:
                        found.append(piece)
                    if piece not in openings:
                        break
                choices.append(found)
            before, left = out[-1] if out else "", choices[-1]
            while left:
                piece = left.pop()
                if at + len(piece) not in dead and self.together(before, piece):
                    out.append(piece)
                    at += len(piece)
                    break
            else:
                dead.add(at)
                choices.pop()
                at -= len(out.pop())
        return out

    def ids(self, pieces: list[str]) -> bytes:
        out = array("I")
        for p in pieces:
            i = self.ident.get(p)
            if i is None:
                out.extend([self.byte_id[b] for b in p.encode("utf-8", "surrogatepass")])
            else:
                out.append(i)
        return out.tobytes()

    def encoded(self, normal: str) -> bytes:
        """Ids of a stretch of normalised text that starts and ends at unit boundaries."""
        runs = self.runs
        out = []
        for u in self.run.findall(normal):
            got = runs.get(u)
            if got is None:
                got = self.ids(self.unit(u))
                if len(runs) > CACHED_UNITS // 4:
                    runs.clear()
                runs[u] = got
            out.append(got)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text; texts with runs of blanks take the general way."""
        if not text:
            return b""
        if ("  " in text or text[0] == " " or text[-1] == " " or " \n" in text or BLANK in text
                or MARK in text):
            return self.encoded(BLANK + text.replace(" ", BLANK))
        if self.stop:  # a stop becomes a marked word
            text = self.stop.sub(f" {MARK}\\g<0>", text)
        if len(self.words) > CACHED_UNITS:
            self.words.clear()
        words, out, feed = self.words, [], self.ids(["\n"])
        for k, line in enumerate(text.split("\n")):
            first, *rest = line.split(" ")
            if k:
                out += [feed, self.encoded(first)]
            else:
                rest.insert(0, first)
            for w in rest:
                got = words.get(w)
                if got is None:
                    got = words[w] = self.ids(self.unit(w[1:] if w[:1] == MARK else BLANK + w))
                out.append(got)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Text of ids; invalid byte sequences become U+FFFD, the leading blank goes."""
        surface = self.surface
        text = b"".join([surface[i] for i in array("I", ids)]).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text

    def boundary(self, text: str, at: int) -> bool:
        """Whether no piece can cover both ``text[at - 1]`` and ``text[at]``."""
        a, b = text[at - 1], text[at]
        return (b == BLANK and a != BLANK) or a == "\n" or b == "\n"

    def states(self, text: str, cut: int) -> list[State]:
        """Pieces that start before ``cut`` and end at or behind it, relative to ``cut``."""
        found = []
        for start in range(max(0, cut - self.longest), cut):
            for end in range(cut, min(len(text), start + self.longest) + 1):
                if text[start:end] in self.score or end - start == 1:
                    found.append((start - cut, end - cut))
        return found

    def head(self, text: str, cut: int, state: State, stop: int) -> tuple[list, int]:
        """Paths from the end of ``state`` at ``cut`` up to ``stop``: (last pieces, first place)."""
        start, end = cut + state[0], cut + state[1]
        return self.path(text[end:stop], text[start:end]), end

    def chunk_matrix(self, text: str, lo: int, hi: int) -> np.ndarray:
        """Transfer matrix of ``text[lo:hi]``; ``text`` has margins around the two cuts.

        A cut at 0 has the one state "start", a cut at the end of ``text`` the one state "end".
        """
        rows = [None] if lo == 0 else self.states(text, lo)
        cols = [None] if hi == len(text) else self.states(text, hi)
        out = np.full((len(rows), len(cols)), NEVER)
        near = lo + self.longest if lo else 0
        first = next((p for p in range(max(near, 1), hi) if self.boundary(text, p)), None)
        last = next((p for p in range(hi - 1, max(near, 1) - 1, -1) if self.boundary(text, p)), None)
        if first is None:
            for r, state in enumerate(rows):
                out[r] = self._exits(text, lo, state, hi, cols)
            return out
        heads = [0.0 if self._reaches(text, lo, s, first) else NEVER for s in rows]
        tails = self._exits(text, last, (0, 0), hi, cols)
        return np.add.outer(heads, tails)

    def _reaches(self, text: str, lo: int, state: State | None, stop: int) -> bool:
        paths, _ = self.head(text, lo, state or (0, 0), stop)
        return bool(paths[-1])

    def _exits(self, text: str, lo: int, state: State | None, hi: int, cols: list) -> np.ndarray:
        """Score of each state at ``hi`` behind ``state`` at ``lo``."""
        paths, origin = self.head(text, lo, state or (0, 0), hi)
        out = np.full(len(cols), NEVER)
        for c, s in enumerate(cols):
            if s is None:
                out[c] = 0.0 if paths[-1] else NEVER
            elif hi + s[0] >= origin:
                before = paths[hi + s[0] - origin]
                if before and self.together(before[0], text[hi + s[0]:hi + s[1]]):
                    out[c] = 0.0
        return out

    def traced(self, text: str, lo: int, hi: int, enter: int, leave: int) -> bytes:
        """Ids of the pieces that start in ``text[lo:hi]`` between the two known states."""
        state = None if lo == 0 else self.states(text, lo)[enter]
        exit_ = None if hi == len(text) else self.states(text, hi)[leave]
        begin = lo + (state[1] if state else 0)
        end = hi + exit_[0] if exit_ else hi
        near = begin + 1
        first = next((p for p in range(near, end) if self.boundary(text, p)), None)
        before = text[lo + state[0]:begin] if state else ""
        tail = [text[hi + exit_[0]:hi + exit_[1]]] if exit_ else []
        if first is None:
            return self.ids(self._back(text[begin:end], before) + tail)
        last = next(p for p in range(end - 1, first - 1, -1) if self.boundary(text, p))
        return (self.ids(self._back(text[begin:first], before)) + self.encoded(text[first:last])
                + self.ids(self._back(text[last:end], "") + tail))

    def packed(self, ids: bytes) -> bytes:
        """Ids in two bytes each where the vocabulary allows it."""
        return np.frombuffer(ids, dtype="<u4").astype("<u2").tobytes() if self.short else ids

    def unpacked(self, ids: bytes) -> bytes:
        return np.frombuffer(ids, dtype="<u2").astype("<u4").tobytes() if self.short else ids

    def _back(self, text: str, before: str) -> list[str]:
        paths, out, i = self.path(text, before), [], len(text)
        while i:
            out.append(paths[i][0])
            i -= len(paths[i][0])
        return out[::-1]


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Associative product of two transfer matrices."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def scan(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """(state at the left cut, state at the right cut) of every chunk on the best path."""
    forward = [matrices[0]]
    for m in matrices[1:]:
        forward.append(max_plus(forward[-1], m))
    backward = [matrices[-1]]
    for m in matrices[-2::-1]:
        backward.append(max_plus(m, backward[-1]))
    backward.reverse()
    cuts = [0]
    for k in range(len(matrices) - 1):
        cuts.append(int((forward[k][0] + backward[k + 1][:, 0]).argmax()))
    cuts.append(0)
    return list(zip(cuts[:-1], cuts[1:]))


_PIECES: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def _normal(text: str) -> str:
    return BLANK + text.replace(" ", BLANK)


def _chunks(giants: DataFrame, model: str, chunk: int) -> DataFrame:
    """``(key, at, body, lo, hi)``: the chunks of the giant texts, with margins.

    One row stands for each different text: the one whose ``__row`` is smallest, found without its text.  Rows
    repeated exactly in other tasks are told apart later, by ``(key, at)``."""
    chosen = frozen(giants.groupBy("__key").agg(F.min("__row").alias("__row")))
    giants = giants.join(sized_broadcast(chosen), ["__key", "__row"], "left_semi")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margin, seen = pieces(model).longest, set()
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if key in seen:
                    continue
                seen.add(key)
                normal = _normal(text)
                for at, begin in enumerate(range(0, len(normal), chunk)):
                    left = max(0, begin - margin)
                    stop = min(len(normal), begin + chunk)
                    body = normal[left:stop + margin]
                    # a margin of at least one character tells an inner cut from a text's end
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key]), pa.array([at], pa.int32()), pa.array([body]),
                         pa.array([begin - left], pa.int32()), pa.array([stop - left], pa.int32())],
                        names=["key", "at", "body", "lo", "hi"])

    return (giants.select("__key", "__text")
            .mapInArrow(work, "key string, at int, body string, lo int, hi int"))


def _giant_ids(giants: DataFrame, model: str, chunk: int, decoded: bool) -> DataFrame:
    """``(key, ids, decoded)`` of every different giant text by the parallel scan.

    Chunk bodies are written once and never shuffled: only transfer matrices and ids are."""
    cut = frozen(_chunks(giants, model, chunk))

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for b in _slices(batches):
            made = [p.chunk_matrix(body, lo, hi) for body, lo, hi in
                    zip(*(b.column(c).to_pylist() for c in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([m.shape[0] for m in made], pa.int32()),
                 pa.array([m.tobytes() for m in made], pa.binary())], names=["key", "at", "rows", "m"])

    def combined(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("at").sort_values("at")
        mats = [np.frombuffer(m).reshape(r, -1) for m, r in zip(pdf["m"], pdf["rows"])]
        both = scan(mats)
        return pd.DataFrame({"key": pdf["key"].to_numpy(), "at": pdf["at"].to_numpy(),
                             "enter": [x for x, _ in both], "leave": [y for _, y in both]})

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for b in _slices(batches):
            ids = [p.packed(p.traced(*row)) for row in zip(*(b.column(c).to_pylist() for c in (2, 3, 4, 5, 6)))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.binary())],
                                             names=["key", "at", "ids"])

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pieces(model).unpacked(b"".join(pdf.drop_duplicates("at").sort_values("at")["ids"]))
        return pd.DataFrame({"key": [pdf["key"].iloc[0]], "ids": [ids],
                             "decoded": [pieces(model).decode(ids) if decoded else None]})

    states = (cut.mapInArrow(matrices, "key string, at int, rows int, m binary")
              .groupBy("key").applyInPandas(combined, "key string, at int, enter int, leave int"))
    traced = (cut.join(sized_broadcast(frozen(states)), ["key", "at"])
              .select("key", "at", "body", "lo", "hi", "enter", "leave")
              .mapInArrow(trace, "key string, at int, ids binary"))
    # a text's ids are one value, as the text is
    return traced.groupBy("key").applyInPandas(joined, "key string, ids binary, decoded string")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, ROWS_TOGETHER):
            yield b.slice(at, ROWS_TOGETHER)


def encode(docs: DataFrame, model: str, text_col: str = "text", chunk: int = CHUNK,
           keep_text: bool = True, decoded: str | None = None) -> DataFrame:
    """``docs`` plus ``ids`` (little-endian 32-bit bytes) as SentencePiece encodes its text.

    ``decoded`` names a further column with the text that the ids decode to;
    ``keep_text=False`` leaves the text column out.

    A null or empty text has no ids.  Texts over ``chunk`` characters go through the
    parallel scan, each different one once.  Repeated rows stay; an input column
    named ``ids`` is replaced; an empty frame gives an empty one.
    """
    names = [c for c in docs.columns if c not in ("ids", decoded) and (keep_text or c != text_col)]
    base = python_ready(docs).select(*[F.col(f"`{c}`") for c in names],
                                     text_of(text_col).alias("__text"))
    size = F.length("__text")
    made = [T.StructField("ids", T.BinaryType())] + [T.StructField(c, T.StringType())
                                                     for c in [decoded] if c]
    schema = T.StructType([*(docs.schema[c] for c in names), *made])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for b in _slices(batches):
            ids = [p.encode(t) for t in b.column(b.num_columns - 1).to_pylist()]
            texts = [pa.array([p.decode(i) for i in ids], pa.string())] if decoded else []
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(b.num_columns - 1)), pa.array(ids, pa.binary()), *texts],
                names=schema.names)

    small = base.where(size <= chunk).mapInArrow(work, schema)
    giants = base.where(size > chunk).withColumn("__key", F.sha2("__text", 256)).withColumn(
        "__row", F.xxhash64("__key", *[F.col(f"`{c}`").cast("string") for c in names if c != text_col]))
    by_key = (_giant_ids(giants, model, chunk, bool(decoded))
              .select(F.col("key").alias("__of"), F.col("ids").alias("__ids"),
                      F.col("decoded").alias("__decoded")))
    # written, the giant rows have a known size: without their texts they are small enough to broadcast
    rows = frozen(giants.drop("__text", "__row"))
    large = (by_key.join(sized_broadcast(rows), F.col("__key") == F.col("__of"))
             .select(*[F.col(f"`{c}`") for c in names], F.col("__ids").alias("ids"),
                     *[F.col("__decoded").alias(c) for c in [decoded] if c]))
    return small.union(large)


def decode(encoded: DataFrame, model: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` plus ``out``, the text of its ids (null for null ids)."""
    names = [c for c in encoded.columns if c != out]
    schema = T.StructType([*(encoded.schema[c] for c in names), T.StructField(out, T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for b in _slices(batches):
            texts = [None if i is None else p.decode(i)
                     for i in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(b.num_columns - 1)), pa.array(texts, pa.string())],
                names=schema.names)

    return (python_ready(encoded).select(*[F.col(f"`{c}`") for c in names],
                                         F.col(f"`{ids_col}`").alias("__ids"))
            .mapInArrow(work, schema))
