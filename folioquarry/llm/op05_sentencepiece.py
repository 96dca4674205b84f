"""SentencePiece encoding and decoding, giant documents by a max-plus parallel scan.

The model is a byte-pair model with byte fallback. An encoding is a path through the lattice of the
text's pieces, and the path that merging would give is the one in which every two neighbours are what
merging makes of the two alone; it is unique. A step of the lattice so weighs 0 if its two pieces may
stand together and minus infinity if not, and a path's weight is the sum: max-plus algebra.

A giant text is cut into chunks of ``giant`` characters wherever that falls, inside words too. A chunk has
states at its borders: the piece that ends at the border or reaches over it. Its transfer matrix holds the best
weight from each state at its start to each at its end. Where no piece of the model can cross (before a space
mark that follows another character, and around characters without a piece) the lattice has one state, so a matrix
is the max-plus product of a column (from the states at the start to the first such place) and a row (from
the last such place to the states at the end); only these two ends are walked piece by piece. Matrices of
``FAN`` neighbours are combined associatively, tasks taking neighbours each, and so on up a tree to one matrix a
text. Down the tree again each product is settled: of the states at its two ends those between follow. Then every
chunk is traced back on its own: its ends through the lattice, the words between by merging.

A text of at most ``giant`` characters is one chunk without a border, encoded in a plain map without a shuffle.
Defined results: a null text has null pieces; an empty text has none; repeated rows get a row each; an empty table gives
no rows; further columns are kept, but those named as the results are replaced. U+2581 in a text decodes to
a space, as the model defines it, and is the only loss.
"""

from __future__ import annotations

import hashlib
import re
from functools import reduce
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mapped, scratch, written

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
GIANT = 60_000
#: Neighbouring matrices that one step of the scan combines.
FAN = 16
SPACE = "▁"
#: Characters of words and pairs that a worker remembers before it starts anew.
REMEMBERED = 1_000_000
NEVER = float("-inf")
#: A run without a place to cut that is longer than this goes through the lattice.
LONG_WORD = 200


class Pieces:
    """A byte-pair model: its pieces, the encoding of words, and the lattice of chunks."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        self.processor = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.rank: dict[str, int] = {}
        self.text: list[bytes] = []
        byte_ids = [0] * 256
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                byte_ids[value] = i
                self.text.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.text.append(b"")
            else:
                self.rank[piece] = i
                self.text.append(piece.replace(SPACE, " ").encode())
        self.score = {p: sp.get_score(i) for p, i in self.rank.items()}
        self.byte_ids = byte_ids
        self.chars = {c for p in self.rank for c in p}
        self.longest = max(map(len, self.rank), default=1)
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.rank):
            raise ValueError("pieces of this model cross spaces; only models that split at white space are supported")
        self.words = _Words(self)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.paired = 0
        # a line feed without a piece is a place to cut, too
        self.splitter = re.compile(f"{SPACE}*[^{SPACE}\n]+|\n|{SPACE}+" if "\n" not in self.chars else f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def ids(self, pieces: list[str]) -> bytes:
        out: list[int] = []
        for p in pieces:
            found = self.rank.get(p)
            out.extend([found] if found is not None else [self.byte_ids[b] for b in p.encode()])
        return np.array(out, dtype=np.int32).tobytes()

    def merge(self, word: str) -> list[str]:
        """Merges neighbours, best score first and leftmost of equals, until none is a piece."""
        parts = list(word)
        score = self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fit_together(self, a: str, b: str) -> bool:
        found = self.pairs.get((a, b))
        if found is None:
            self.paired += len(a) + len(b)
            if self.paired > REMEMBERED:
                self.forget()
            found = self.pairs[a, b] = self.merge(a + b) == ([a, b] if b else [a])
        return found

    def forget(self) -> None:
        self.pairs.clear()
        self.paired = 0
        self.words.clear()

    def at(self, text: str, start: int) -> list[str]:
        """Pieces that start here; a character without a piece stands for its bytes."""
        longer = (text[start:to] for to in range(start + 2, min(start + self.longest, len(text)) + 1))
        return [text[start], *(p for p in longer if p in self.rank and self.stands(p))]

    def stands(self, piece: str) -> bool:
        """Whether merging ever makes this piece of its own characters."""
        return self.fit_together(piece, "")

    def cut_at(self, text: str, i: int) -> bool:
        """Whether no piece crosses position i."""
        if i <= 0 or i >= len(text):
            return True
        return (text[i] == SPACE and text[i - 1] != SPACE) or text[i] not in self.chars or text[i - 1] not in self.chars

    # states are (piece, end); a place to cut has the one state ("", position)

    def border(self, text: str, at: int) -> list[tuple[str, int]]:
        """The states at a border, in order."""
        if self.cut_at(text, at):
            return [("", at)]
        out = []
        for start in range(max(0, at - self.longest), at):
            out += [(p, start + len(p)) for p in self.at(text, start) if start + len(p) >= at]
        return out

    def inner_cuts(self, text: str, begin: int, end: int) -> tuple[int, int] | None:
        """The first and the last place within a chunk that no piece crosses, its borders included; None if there is none."""
        first = next((i for i in range(begin, end + 1) if self.cut_at(text, i)), None)
        return None if first is None else (first, next(i for i in range(end, begin - 1, -1) if self.cut_at(text, i)))

    def lattice(self, text: str, begin: int, end: int, entering: list[tuple[str, int]]) -> list[dict[str, np.ndarray]]:
        """For each position from ``begin``: piece ending there -> best weight from each of the entering states."""
        reach: list[dict[str, np.ndarray]] = [{} for _ in range(end - begin + self.longest + 1)]
        for k, (piece, to) in enumerate(entering):
            start = reach[to - begin].setdefault(piece, np.full(len(entering), NEVER))
            start[k] = 0.0
        for at in range(begin, end):
            here = reach[at - begin]
            if not here:
                continue
            free = self.cut_at(text, at)
            for t in self.at(text, at):
                before = [w for u, w in here.items() if free or u == "" or self.fit_together(u, t)]
                if before:
                    there = reach[at + len(t) - begin]
                    there[t] = np.maximum.reduce([*before, *([there[t]] if t in there else [])])
        return reach

    def weights(self, text: str, begin: int, end: int) -> np.ndarray:
        """The matrix of a stretch, walked through its whole lattice: states at its start by states at its end."""
        entering = self.border(text, begin)
        reach = self.lattice(text, begin, end, entering)
        out = np.full((len(entering), len(leaving := self.border(text, end))), NEVER)
        for j, (piece, to) in enumerate(leaving):
            for p, w in reach[to - begin].items():
                if p == piece or piece == "":
                    out[:, j] = np.maximum(out[:, j], w)
        return out

    def transfer(self, text: str, begin: int, end: int) -> np.ndarray:
        """The matrix of a chunk: its ends walked, and between its first and last cut the one state, of weight 0."""
        cuts = self.inner_cuts(text, begin, end)
        if cuts is None:
            return self.weights(text, begin, end)
        return compose(self.weights(text, begin, cuts[0]), self.weights(text, cuts[1], end))

    def trace(self, text: str, begin: int, end: int, first: int, last: int) -> bytes:
        """The ids of a chunk's pieces that end after ``begin`` and up to the state at its end."""
        cuts = self.inner_cuts(text, begin, end)
        if cuts is None:
            return self.ids(self.walk_back(text, begin, end, first, last))
        head = self.walk_back(text, begin, cuts[0], first, 0)
        return self.ids(head) + self.encode(text[cuts[0] : cuts[1]]) + self.ids(self.walk_back(text, cuts[1], end, 0, last))

    def walk_back(self, text: str, begin: int, end: int, first: int, last: int) -> list[str]:
        """The pieces of a stretch on the best path between a state at its start and one at its end."""
        entering = self.border(text, begin)[first]
        reach = self.lattice(text, begin, end, [entering])
        piece, at = self.border(text, end)[last]

        def best(here: dict[str, np.ndarray], fits) -> str:
            return max((p for p, w in here.items() if w[0] > NEVER and fits(p)), key=lambda p: here[p][0], default="")

        if piece == "":
            piece = best(reach[at - begin], lambda p: True) if at > entering[1] else ""
        out: list[str] = []
        while piece and (piece, at) != entering:
            out.append(piece)
            at -= len(piece)
            free, after = self.cut_at(text, at), piece
            piece = best(reach[at - begin], lambda u: free or u == "" or self.fit_together(u, after))  # noqa: B023
        return out[::-1]

    def encode(self, text: str) -> bytes:
        """Ids of a normalised text, as 32-bit integers."""
        words = self.words
        return b"".join([words[w] for w in self.splitter.findall(text)])

    def decode(self, ids: np.ndarray) -> str:
        table = self.text
        return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")[1:]


class _Words(dict):
    """Word -> ids, filled as words come."""

    def __init__(self, pieces: Pieces) -> None:
        super().__init__()
        self.pieces, self.held = pieces, 0

    def __missing__(self, word: str) -> bytes:
        p = self.pieces
        if len(word) > LONG_WORD:
            return p.ids(p.walk_back(word, 0, len(word), 0, 0))
        if self.held > REMEMBERED:
            self.clear()
        self.held += len(word)
        if 1 < len(word) and word[0] == SPACE != word[1]:  # the library merges words, and puts a mark before them
            found = self[word] = np.array(p.processor.encode(word[1:]), dtype=np.int32).tobytes()
        else:
            found = self[word] = p.ids(p.merge(word))
        return found

    def clear(self) -> None:
        super().clear()
        self.held = 0


def normalised(text: str) -> str:
    """Spaces become marks, one more stands before the text; nothing else changes."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def compose(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product: of the matrices of two neighbours, that of both; associative."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def settle(matrices: list[np.ndarray], first: int, last: int) -> list[int]:
    """The states at all borders of neighbours, from those at the two ends of them all."""
    best = [np.full(matrices[0].shape[0], NEVER)]
    best[0][first] = 0.0
    for m in matrices:
        best.append((best[-1][:, None] + m).max(axis=0))
    states = [last]
    for k in range(len(matrices) - 1, -1, -1):
        states.insert(0, int(np.argmax(best[k] + matrices[k][:, states[0]])))
    return states


_loaded: dict[bytes, Pieces] = {}


def load(model: bytes) -> Pieces:
    key = hashlib.sha256(model).digest()
    if key not in _loaded:
        _loaded[key] = Pieces(model)
    return _loaded[key]


def _encode_short(model: bytes, names: list[str], check: bool):
    def run(batches):
        import pyarrow as pa

        pieces = load(model)
        at = names.index("text")
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                batch = whole.slice(k, 256)
                texts = batch.column(at).to_pylist()
                ids = [pieces.encode(normalised(t)) if t is not None else None for t in texts]
                yield _result(pa, pieces, batch, names, texts, ids, check)
        pieces.forget()

    return run


def _result(pa, pieces: Pieces, batch, names: list[str], texts: list, ids: list, check: bool):
    if check:
        arrays = [np.frombuffer(x, dtype=np.int32) if x is not None else None for x in ids]
        more = [
            pa.array([None if a is None else len(a) for a in arrays], pa.int64()),
            pa.array([None if x is None else hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
            pa.array([None if a is None else pieces.decode(a) == t for a, t in zip(arrays, texts, strict=True)], pa.bool_()),
        ]
        added = ["n_pieces", "ids_sha256", "round_trip"]
    else:
        offsets = np.concatenate(([0], np.cumsum([len(x or b"") // 4 for x in ids]))).astype(np.int32)
        values = pa.array(np.frombuffer(b"".join(x or b"" for x in ids), dtype=np.int32))
        missing = pa.array([x is None for x in ids])
        more, added = [pa.ListArray.from_arrays(pa.array(offsets), values, mask=missing)], ["ids"]
    return pa.RecordBatch.from_arrays([*[c for c, n in zip(batch.columns, names, strict=True) if not (check and n == "text")], *more], names=[*[n for n in names if not (check and n == "text")], *added])


def _chunks(model: bytes, size: int):
    """(row, text) -> (row, chunk, begin, end, part): each chunk with what borders it, and where in that it lies."""

    def run(batches):
        import pyarrow as pa

        pieces = load(model)
        around = pieces.longest + 1
        for batch in batches:
            for row, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = normalised(raw)
                for chunk, begin in enumerate(range(0, len(text), size)):
                    end = min(begin + size, len(text))
                    lead = min(begin, around)
                    part = text[begin - lead : end + around]
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((row, chunk, lead, lead + end - begin, part), (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string()), strict=True)], names=["row", "chunk", "begin", "end", "part"])

    return run


_CHUNK_SCHEMA = "row bigint, chunk int, begin int, end int, part string"
_NODE_SCHEMA = "row bigint, node int, starts int, cells array<double>"
_STATE_SCHEMA = "row bigint, node int, first int, last int"


def _matrices(model: bytes):
    """Chunks -> nodes of the tree's lowest level: (row, node, starts, cells), cells by rows."""

    def run(batches):
        import pyarrow as pa

        pieces = load(model)
        for batch in batches:
            rows = batch.to_pylist()
            found = [pieces.transfer(r["part"], r["begin"], r["end"]) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["row"] for r in rows], pa.int64()), pa.array([r["chunk"] for r in rows], pa.int32()),
                 pa.array([m.shape[0] for m in found], pa.int32()), pa.array([m.ravel().tolist() for m in found], pa.list_(pa.float64()))],
                names=["row", "node", "starts", "cells"],
            )

    return run


def _as_matrices(nodes: list[dict]) -> list[np.ndarray]:
    return [np.array(n["cells"]).reshape(n["starts"], -1) for n in nodes]


def _combined(batches):
    """(row, node, nodes: ``FAN`` neighbours at most, in order) -> the node of their product."""
    import pyarrow as pa

    for batch in batches:
        rows = batch.to_pylist()
        found = [reduce(compose, _as_matrices(r["nodes"])) for r in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r["row"] for r in rows], pa.int64()), pa.array([r["node"] for r in rows], pa.int32()),
             pa.array([m.shape[0] for m in found], pa.int32()), pa.array([m.ravel().tolist() for m in found], pa.list_(pa.float64()))],
            names=["row", "node", "starts", "cells"],
        )


def _settled(batches):
    """(row, nodes, first, last): neighbours with the states at their two ends -> the states at the ends of each."""
    import pyarrow as pa

    for batch in batches:
        out: list[tuple[int, int, int, int]] = []
        for r in batch.to_pylist():
            states = settle(_as_matrices(r["nodes"]), r["first"], r["last"])
            out += [(r["row"], n["node"], a, b) for n, a, b in zip(r["nodes"], states[:-1], states[1:], strict=True)]
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["row", "node", "first", "last"])


def _traced(model: bytes):
    def run(batches):
        import pyarrow as pa

        pieces = load(model)
        for batch in batches:
            rows = batch.to_pylist()
            ids = [pieces.trace(r["part"], r["begin"], r["end"], r["first"], r["last"]) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["row"] for r in rows], pa.int64()), pa.array([r["chunk"] for r in rows], pa.int32()), pa.array(ids, pa.binary())],
                names=["row", "chunk", "ids"],
            )

    return run


def _joined_chunks(model: bytes, names: list[str], check: bool):
    """(doc, chunks: the ids of each, in order) -> rows of the result."""

    def run(batches):
        import pyarrow as pa

        pieces = load(model)
        for batch in batches:
            ids = [b"".join(c["ids"] for c in cs) for cs in batch.column(1).to_pylist()]
            own = pa.RecordBatch.from_arrays(batch.column(0).flatten(), names=names)
            yield _result(pa, pieces, own, names, own.column(names.index("text")).to_pylist(), ids, check)

    return run


def border_states(chunks: DataFrame, model: bytes, fan: int = FAN) -> DataFrame:
    """(row, node, first, last): the states at the start and end of every chunk, by a scan up and down a tree of matrices.

    A step up reads the nodes of one level and writes those of the next, of which there are ``fan`` times fewer; no task
    sees more than ``fan`` matrices of a text at once. The number of steps grows with the logarithm of the longest text.
    """
    levels = [written(mapped(chunks, _matrices(model), _NODE_SCHEMA))]
    node = F.struct("node", "starts", "cells")

    def neighbours(level: DataFrame) -> DataFrame:
        return level.groupBy("row", F.floor(F.col("node") / fan).cast("int").alias("above")).agg(F.array_sort(F.collect_list(node)).alias("nodes"))

    while (levels[-1].agg(F.max("node")).first()[0] or 0) > 0:
        levels.append(written(mapped(neighbours(levels[-1]).select("row", F.col("above").alias("node"), "nodes"), _combined, _NODE_SCHEMA)))
    # a text starts and ends at places to cut, so its one matrix has one state at each end
    states = levels[-1].select("row", "node", F.lit(0).alias("first"), F.lit(0).alias("last"))
    for level in reversed(levels[:-1]):
        given = neighbours(level).join(states.withColumnRenamed("node", "above"), ["row", "above"])
        states = written(mapped(given.select("row", "nodes", "first", "last"), _settled, _STATE_SCHEMA))
    return states


def model_bytes(spark: SparkSession, path: str) -> bytes:
    """The model's file, read on the driver where it is local and by Spark where it is elsewhere."""
    if ":" not in path:
        return Path(path).read_bytes()
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def encode(docs: DataFrame, model_path: str = MODEL_PATH, giant: int = GIANT, check: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (array<int>); with ``check``, in place of text and ids: n_pieces, ids_sha256, round_trip."""
    spark = docs.sparkSession
    model = model_bytes(spark, model_path)
    if giant < Pieces(model).longest:
        raise ValueError("chunks must be longer than the longest piece")
    names = [c for c in docs.columns if c not in ("ids", "n_pieces", "ids_sha256", "round_trip")]
    docs = docs.select(*names)
    schema = docs.drop("text") if check else docs
    extra = "n_pieces bigint, ids_sha256 string, round_trip boolean" if check else "ids array<int>"
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in schema.schema], extra])
    big = F.coalesce(F.char_length("text") > giant, F.lit(False))
    short = mapped(docs.where(~big), _encode_short(model, names, check), schema)
    with scratch(spark):
        # giant texts, written once with a row number that then stays
        large = written(docs.where(big).select(F.struct(*names).alias("doc"), F.monotonically_increasing_id().alias("row")), keep=True)
        chunks = written(mapped(large.select("row", "doc.text"), _chunks(model, giant), _CHUNK_SCHEMA).repartition("row", "chunk"))
        states = border_states(chunks, model).withColumnRenamed("node", "chunk")
        traced = mapped(chunks.join(states, ["row", "chunk"]), _traced(model), "row bigint, chunk int, ids binary")
        whole = written(traced.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("chunks")), keep=True)
    long = mapped(large.join(whole, "row").select("doc", "chunks"), _joined_chunks(model, names, check), schema)
    return short.unionByName(long)


def decode(encoded: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """``encoded`` with ``text`` from ``ids``; null ids give a null text, empty ones an empty text, and ``text``, if there is one, is replaced.

    Rows are decoded one by one, of any length, so repeated rows stay as many as they are and an empty table gives no rows; all other columns are kept.
    """
    spark = encoded.sparkSession
    model = model_bytes(spark, model_path)
    kept = [c for c in encoded.columns if c not in ("ids", "text")]

    def run(batches):
        import pyarrow as pa

        pieces = load(model)
        for batch in batches:
            texts = [None if ids is None else pieces.decode(np.array(ids, dtype=np.int32)) for ids in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(texts, pa.string())], names=[*kept, "text"])

    return mapped(encoded.select(*kept, "ids"), run, encoded.select(*kept).withColumn("text", F.lit(None).cast("string")).schema)


def piece_rows(docs: DataFrame, model_path: str = MODEL_PATH) -> DataFrame:
    """The rows of query op5: doc_id, n_chars, n_pieces, ids_sha256 (32-bit little-endian ids), round_trip."""
    return encode(docs.select("doc_id", F.coalesce(F.char_length("text"), F.lit(0)).cast("bigint").alias("n_chars"), "text"), model_path, check=True)
