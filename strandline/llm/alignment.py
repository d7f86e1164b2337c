"""Cross-tokenizer alignment: which tokens of two tokenizers overlap, and how often each pair does in the corpus.

Documents' pair records are kept in runs, compressed and cut by a radix of the second token, in order of second
token, first token and document. A heap merge of the runs' pairs, several runs at a time, counts each pair; as the
order has the second token first, its highest count is known as soon as its last pair has passed. The counts then
meet the runs again, and each run gives back what they add to its documents.
"""

from __future__ import annotations

import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from strandline.llm.common import frugal, ready, table
from strandline.llm.units import TEXT_PART, UNIT_CHARS, BatchUnits, byte_level, cut_units, gathered, larger_batches, piece_level, text_pieces
from strandline.session import land

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
HELD = 200_000  # distinct units that a worker remembers, about
RUN_LINKS, RUN_DOCS = 1 << 22, 1 << 15  # a run is closed beyond these
LONG_DOC = 1 << 20  # links of one document that are counted up before going on
ALIGN_BYTES = 12 << 20  # of texts whose distinct units are aligned at once
RADIX = 32  # parts, by second token
FAN = 64  # runs merged at once, on average
BLOCK = 1 << 16  # pairs in a block

_MASK = np.uint64(0xFFFFFFFF)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 in the least width that holds them, as compressed byte planes."""
    most = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    planes = np.ascontiguousarray(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(raw: bytes) -> np.ndarray:
    cells = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), np.uint8).reshape(raw[0], -1)
    return np.ascontiguousarray(cells.T).view(f"<u{raw[0]}").reshape(-1).astype(np.uint64)


def byte_lengths_first(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary: printable characters stand for themselves, others are moved up."""
    library = Tokenizer.from_file(path)
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(own)))}
    table_ = {**{chr(b): b for b in own}, **moved}
    return [bytes(table_[c] for c in library.id_to_token(i) or "") for i in range(library.get_vocab_size())]


def byte_lengths_second(path: str) -> list[bytes]:
    """The bytes of each piece: U+2581 is a blank, <0xHH> a byte."""
    library = SentencePieceProcessor(model_file=path)
    found = []
    for i in range(library.vocab_size()):
        piece = library.id_to_piece(i)
        found.append(bytes([int(piece[3:5], 16)]) if library.is_byte(i) else piece.replace("▁", " ").encode())
    return found


def align(first: list[int], second: list[int], first_bytes: list[bytes], second_bytes: list[bytes]) -> tuple[str, int, list[int]]:
    """The groups as text, their number, and the links, each as second id * 2^32 + first id, of tokens of the same bytes."""
    groups, links, i, j, from_i, from_j = [], [], 0, 0, 0, 0
    end_i = end_j = 0
    while i < len(first) and j < len(second):
        after_i, after_j = end_i + len(first_bytes[first[i]]), end_j + len(second_bytes[second[j]])
        links.append(second[j] << 32 | first[i])
        if after_i <= after_j:
            i, end_i = i + 1, after_i
        if after_j <= after_i:
            j, end_j = j + 1, after_j
        if after_i == after_j:
            groups.append(f"{','.join(map(str, first[from_i:i]))}|{','.join(map(str, second[from_j:j]))}")
            from_i, from_j = i, j
    return ";".join(groups), len(groups), links


class Aligner:
    """Alignments of distinct units; a text's alignment is that of its units, one after the other."""

    def __init__(self, first: str, second: str, held: int = HELD):
        self.encode = byte_level(first, plain=True), piece_level(second)
        self.bytes = byte_lengths_first(first), byte_lengths_second(second)
        self.held = held
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}  # what was known before `known` last became full

    def of(self, units: list[str]) -> list[tuple | None]:
        """(text of groups, first tokens, second tokens, groups, links) of each unit; None if a tokenizer changes its bytes."""
        if len(self.known) > self.held // 2:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        absent = {unit for unit in units if unit not in known}
        known.update({unit: older[unit] for unit in absent if unit in older})
        new = [unit for unit in absent if unit not in older]
        if new:
            for unit, a, b in zip(new, self.encode[0](new), self.encode[1](new), strict=True):
                raw = unit.encode()
                if any(b"".join([spelled[i] for i in ids]) != raw for ids, spelled in zip((a, b), self.bytes, strict=True)):
                    known[unit] = None
                else:
                    groups, n_groups, links = align(a, b, *self.bytes)
                    known[unit] = groups, len(a), len(b), n_groups, array("Q", links).tobytes()
        found = [known[unit] for unit in units]
        for unit in new:
            if len(unit) > UNIT_CHARS:
                del known[unit]
        return found

    def documents(self, texts: pa.Array) -> Iterator[tuple | None]:
        """What `document` gives for each text of a batch; null and empty ones have no tokens."""
        filled = pc.greater(pc.fill_null(pc.binary_length(texts), 0), 0)
        given = texts.filter(filled)
        cut = BatchUnits(given, spaced=True)
        found = self.of(cut.units)
        spelled = [unit[0] if unit else "" for unit in found]
        numbers = np.array([unit[1:4] if unit else (0, 0, 0) for unit in found], np.int64).reshape(-1, 3)
        links = np.frombuffer(b"".join([unit[4] for unit in found if unit]), np.uint64)
        sizes = np.array([len(unit[4]) // 8 if unit else 0 for unit in found], np.int64)
        bad, at = np.array([unit is None for unit in found], bool), np.cumsum(sizes) - sizes
        k, place = 0, 0
        for is_filled in filled.to_pylist():
            if not is_filled:
                yield None
                continue
            if cut.alone[place]:
                yield self.document(given[place].as_py())
            else:
                which = cut.which[cut.starts[k] : cut.starts[k + 1]]
                if bad[which].any():
                    yield None
                else:
                    codes = links[gathered(at, sizes, which)]
                    digest = hashlib.sha256(";".join([spelled[i] for i in which.tolist()]).encode()).hexdigest()
                    yield digest, *numbers[which].sum(axis=0).tolist(), len(codes), codes, np.ones(len(codes), np.int32)
                k += 1
            place += 1

    def document(self, text: str) -> tuple[str, int, int, int, int, np.ndarray, np.ndarray] | None:
        """Digest, numbers of tokens, groups and links, and the links counted by pair; None if there are no tokens."""
        digest, numbers, n_links, waiting, many = hashlib.sha256(), [0, 0, 0], 0, [], 0
        codes, times = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        for at, part in enumerate(text_pieces(" " + text, TEXT_PART)):
            found = self.of(cut_units(part))
            if None in found:
                return None
            spelled, a, b, groups, links = zip(*found, strict=True)
            digest.update(((";" if at else "") + ";".join(spelled)).encode())
            numbers = [n + sum(x) for n, x in zip(numbers, (a, b, groups), strict=True)]
            waiting.append(np.frombuffer(b"".join(links), np.uint64))
            many += len(waiting[-1])
            if many > LONG_DOC:
                codes, times = _counted([codes, *waiting], [times, np.ones(many, np.int32)])
                n_links, waiting, many = n_links + many, [], 0
        if waiting:
            rest = np.concatenate(waiting)
            codes, times = (np.concatenate([codes, rest]), np.concatenate([times, np.ones(len(rest), np.int32)])) if len(codes) else (rest, np.ones(len(rest), np.int32))
        return digest.hexdigest(), *numbers, n_links + many, codes, times


def _counted(codes: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and the sums of their times."""
    codes, times = np.concatenate(codes), np.concatenate(times)
    order = np.argsort(codes, kind="stable")
    codes, times = codes[order], times[order]
    new = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, np.int64)
    return codes[new], np.add.reduceat(times, new, dtype=np.int64) if len(new) else times


_RUNS = ("run long, part int, low long, codes binary, counts binary, n_docs binary, docs binary, times binary, "
         "doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>")
_RUN_FIELDS = pa.schema([
    ("run", pa.int64()), ("part", pa.int32()), ("low", pa.int64()), *((c, pa.large_binary()) for c in ("codes", "counts", "n_docs", "docs", "times")),
    *((c, pa.list_(pa.int64())) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.list_(pa.large_string()))])
_ROW = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def _packed_codes(codes: np.ndarray) -> bytes:
    """Ascending codes as steps of the second id and the first id."""
    second = codes >> np.uint64(32)
    return b"".join((len(x).to_bytes(4, "little") + x) for x in (pack(np.diff(second, prepend=np.uint64(0))), pack(codes & _MASK)))


def _unpacked_codes(raw: bytes) -> np.ndarray:
    size = int.from_bytes(raw[:4], "little")
    return np.cumsum(unpack(raw[4 : 4 + size]), dtype=np.uint64) << np.uint64(32) | unpack(raw[8 + size :])


def _batch(rows: list[dict], fields: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array([row.get(f.name) for row in rows], f.type) for f in fields], schema=fields)


class _Run:
    """Documents and their pair records, until there are enough for a run."""

    def __init__(self, number: int, radix: int):
        self.number, self.radix = number, radix
        self.rows: list[tuple] = []
        self.records: list[tuple[int, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, doc_id: int | None, found: tuple | None) -> None:
        if found is None:
            self.rows.append((doc_id, 0, 0, 0, 0, ""))
            return
        digest, n_a, n_b, n_groups, n_links, codes, times = found
        self.records.append((len(self.rows), codes, times))
        self.rows.append((doc_id, n_a, n_b, n_groups, n_links, digest))
        self.held += len(codes)

    def closed(self) -> Iterator[pa.RecordBatch]:
        """A row of the documents, and rows of blocks of pair records by part."""
        yield _batch([{"run": self.number, "part": -1} | dict(zip(_ROW, map(list, zip(*self.rows, strict=True)), strict=True))], _RUN_FIELDS)
        if not self.records:
            return
        codes = np.concatenate([c for _, c, _ in self.records])
        docs = np.repeat(np.array([d for d, _, _ in self.records], np.int32), [len(c) for _, c, _ in self.records])
        times = np.concatenate([t for _, _, t in self.records])
        self.records = []
        order = np.argsort(codes, kind="stable")  # documents stay in order within a pair
        codes, docs, times = codes[order], docs[order], times[order]
        new = np.flatnonzero(np.append(True, (codes[1:] != codes[:-1]) | (docs[1:] != docs[:-1])))
        codes, docs, times = codes[new], docs[new], np.add.reduceat(times, new, dtype=np.int64)
        starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        pairs, n_docs, counts = codes[starts], np.diff(np.append(starts, len(codes))), np.add.reduceat(times, starts)
        steps = np.diff(docs, prepend=np.int32(0))
        steps[starts] = docs[starts]
        parts = _part(pairs, self.radix)
        of_record = np.repeat(parts, n_docs)
        for part in np.unique(parts).tolist():
            mine, own = np.flatnonzero(parts == part), of_record == part
            my_steps, my_times, ends = steps[own], times[own] - 1, np.append(0, np.cumsum(n_docs[mine]))
            for at in range(0, len(mine), BLOCK):
                here = mine[at : at + BLOCK]
                low, high = ends[at], ends[at + len(here)]
                yield _batch([{
                    "run": self.number, "part": part, "low": int(pairs[here[0]]), "codes": _packed_codes(pairs[here]), "counts": pack(counts[here]),
                    "n_docs": pack(n_docs[here]), "docs": pack(my_steps[low:high]), "times": pack(my_times[low:high])}], _RUN_FIELDS)


def _part(codes: np.ndarray, radix: int) -> np.ndarray:
    """By the second id alone, so that all its pairs share a part."""
    return ((codes >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(radix)


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(first: str, second: str) -> Aligner:
    """One for each worker process."""
    if (first, second) not in _aligners:
        _aligners.clear()
        _aligners[first, second] = Aligner(first, second)
    return _aligners[first, second]


def build_runs(docs: DataFrame, first: str, second: str, radix: int, run_links: int) -> DataFrame:
    """The stored runs: for each one row of its documents' numbers (part -1), and blocks of pair records."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        aligner, number = _aligner(first, second), TaskContext.get().partitionId() << 32
        held = _Run(number, radix)
        for batch in larger_batches(batches, ALIGN_BYTES):
            for doc_id, found in zip(batch.column(0).to_pylist(), aligner.documents(batch.column(1)), strict=True):
                held.add(doc_id, found)
                if held.held >= run_links or len(held.rows) >= RUN_DOCS:
                    yield from held.closed()
                    number += 1
                    held = _Run(number, radix)
        if held.rows:
            yield from held.closed()

    return land(rows.mapInArrow(run, _RUNS), "runs")


_MERGED = "part int, run long, low long, codes binary, counts binary, best binary"
_MERGED_FIELDS = pa.schema([("part", pa.int32()), ("run", pa.int64()), ("low", pa.int64()), ("codes", pa.large_binary()), ("counts", pa.large_binary()), ("best", pa.large_binary())])


class _Merge:
    """A heap of blocks by their lowest code; what lies below a limit is counted and given out in order."""

    def __init__(self, part: int, run: int):
        self.part, self.run, self.heap, self.seen = part, run, [], 0

    def push(self, codes: np.ndarray, counts: np.ndarray) -> None:
        heapq.heappush(self.heap, (int(codes[0]), self.seen, codes, counts))
        self.seen += 1

    def below(self, limit: int) -> Iterator[dict]:
        taken: list[tuple[np.ndarray, np.ndarray]] = []
        while self.heap and self.heap[0][0] < limit:
            _, _, codes, counts = heapq.heappop(self.heap)
            cut = int(np.searchsorted(codes, np.uint64(limit))) if limit < 1 << 64 else len(codes)
            taken.append((codes[:cut], counts[:cut]))
            if cut < len(codes):
                self.push(codes[cut:], counts[cut:])
        if taken:
            codes, counts = _counted([c for c, _ in taken], [n for _, n in taken])
            second = codes >> np.uint64(32)
            starts = np.flatnonzero(np.append(True, second[1:] != second[:-1]))
            highest = np.repeat(np.maximum.reduceat(counts, starts), np.diff(np.append(starts, len(codes))))
            for at in range(0, len(codes), BLOCK):
                own = slice(at, at + BLOCK)
                yield {"part": self.part, "run": self.run, "low": int(codes[at]), "codes": _packed_codes(codes[own]), "counts": pack(counts[own]),
                       "best": np.packbits(counts[own] == highest[own]).tobytes()}


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by part, group and lowest code; a block is merged with those that begin before the next block's second id."""
    merge = None
    for batch in batches:
        for part, group, low, codes, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if merge is None or (part, group) != (merge.part, merge.run):
                if merge is not None:
                    yield from (_batch([row], _MERGED_FIELDS) for row in merge.below(1 << 64))
                merge = _Merge(part, group)
            yield from (_batch([row], _MERGED_FIELDS) for row in merge.below(low >> 32 << 32))
            merge.push(_unpacked_codes(codes), unpack(counts).astype(np.int64))
    if merge is not None:
        yield from (_batch([row], _MERGED_FIELDS) for row in merge.below(1 << 64))


def count_pairs(runs: DataFrame, fan: int = FAN) -> DataFrame:
    """Blocks of all pairs by part, in order, with their counts and a bit for those that are the highest of their second id."""
    blocks = runs.filter("part >= 0").select("part", "run", "low", "codes", "counts")
    n = runs.filter("part < 0").count()  # one row for each run
    while True:
        groups = max(1, -(-n // fan))
        dealt = blocks.withColumn("run", F.pmod(F.xxhash64("run"), F.lit(groups)))
        merged = dealt.repartition("part", "run").sortWithinPartitions("part", "run", "low").select("part", "run", "low", "codes", "counts").mapInArrow(_merge, _MERGED)
        blocks = land(merged, "pairs")
        if groups == 1:
            return blocks
        n, blocks = groups, blocks.drop("best")


def _contributions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the counts add to each run's documents. Rows come by part and group, the counted pairs first."""
    at, pairs, counts, best = None, [], [], []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["part"], row["group"]) != at:
                at, pairs, counts, best = (row["part"], row["group"]), [], [], []
            codes = _unpacked_codes(row["codes"])
            if row["best"] is not None:
                pairs.append(codes)
                counts.append(unpack(row["counts"]).astype(np.int64))
                best.append(np.unpackbits(np.frombuffer(row["best"], np.uint8), count=len(codes)).astype(np.int64))
                continue
            if len(pairs) > 1:
                pairs, counts, best = ([np.concatenate(x)] for x in (pairs, counts, best))
            place = np.searchsorted(pairs[0], codes)
            n_docs, steps, times = unpack(row["n_docs"]).astype(np.int64), unpack(row["docs"]).astype(np.int64), unpack(row["times"]).astype(np.int64) + 1
            ends = np.cumsum(n_docs)
            sums = np.cumsum(steps)
            docs = sums - np.repeat(np.append(0, sums[ends[:-1] - 1]), n_docs)
            own, where = np.unique(docs, return_inverse=True)
            count_sum, n_best = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
            np.add.at(count_sum, where, times * np.repeat(counts[0][place], n_docs))
            np.add.at(n_best, where, times * np.repeat(best[0][place], n_docs))
            yield pa.record_batch([pa.array([row["run"]]), *(pa.array([pack(x)], pa.large_binary()) for x in (own, n_best, count_sum))], ["run", "docs", "n_best", "count_sum"])


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each run; rows come by run, that of its documents first."""
    run, rows, n_best, count_sum = None, None, None, None

    def done() -> pa.RecordBatch:
        return pa.record_batch([pa.array(rows[c], pa.large_string() if c == "groups_sha256" else pa.int64()) for c in _ROW] + [pa.array(n_best), pa.array(count_sum)], [*_ROW, "n_best", "count_sum"])

    for batch in batches:
        for row in batch.to_pylist():
            if row["run"] != run:
                if run is not None:
                    yield done()
                run, rows = row["run"], row
                n_best, count_sum = np.zeros(len(row["doc_id"]), np.int64), np.zeros(len(row["doc_id"]), np.int64)
            else:
                docs = unpack(row["docs"]).astype(np.int64)
                n_best[docs] += unpack(row["best"]).astype(np.int64)
                count_sum[docs] += unpack(row["counts"]).astype(np.int64)
    if run is not None:
        yield done()


def align_documents(docs: DataFrame, first: str | None = None, second: str | None = None, radix: int = RADIX, fan: int = FAN, run_links: int = RUN_LINKS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    Null and empty texts, and those whose bytes a tokenizer changes, have zeros and an empty digest; repeated rows
    count each; other columns are left out; an empty table gives an empty table. A task holds a run, whose size is
    bounded but for a single document's distinct pairs; a merge holds a block of each of its runs; a document's
    counts return to the run that holds it, so a token or pair of any frequency has no task of its own.
    """
    ready(docs.sparkSession)
    runs = build_runs(docs, first or public_tokenizers.path(FIRST), second or public_tokenizers.path(SECOND), radix, run_links)
    pairs = count_pairs(runs, fan)
    groups = max(1, -(-runs.filter("part < 0").count() // fan))
    blank = [F.lit(None).cast("binary").alias(c) for c in ("n_docs", "docs", "times")]
    columns = ["part", "group", "run", "low", "codes", "counts", "best", "n_docs", "docs", "times"]
    counted = pairs.select("*", *blank).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("run", F.lit(-1).cast("long"))
    blocks = runs.filter("part >= 0").withColumn("group", F.pmod(F.xxhash64("run"), F.lit(groups)).cast("int")).withColumn("best", F.lit(None).cast("binary"))
    both = counted.select(*columns).unionByName(blocks.select(*columns)).repartition("part", "group").sortWithinPartitions("part", "group", F.col("best").isNull(), "low")
    added = both.mapInArrow(_contributions, "run long, docs binary, n_best binary, count_sum binary")
    numbers = [c for c in _ROW]
    owners = runs.filter("part < 0").select("run", *numbers, *(F.lit(None).cast("binary").alias(c) for c in ("docs", "best", "counts")))
    sums = added.select("run", "docs", F.col("n_best").alias("best"), F.col("count_sum").alias("counts"))
    rows = owners.unionByName(sums, allowMissingColumns=True).repartition("run").sortWithinPartitions("run", F.col("docs").isNotNull())
    kinds = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return rows.mapInArrow(_finished, kinds).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alignment of every document's tokens of two vocabularies."""
    return align_documents(table(spark, sf_dir, "documents"))
