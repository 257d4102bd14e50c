"""Records of large CSV files cut in parallel, quoted line breaks included.

Where a split of a file begins, nothing tells whether it is inside a quoted field. Each line either leaves that as it is,
turns it round, or settles it; so does each split, which its lines make up. A first pass reads every split under both assumptions
and keeps three things: how it ends under either, the lines before its first record, and those after its last. How a
split really begins follows from the splits before it, by windows over one row per split. A second pass then cuts the
records that lie within a split, and those across splits are put together from the kept lines. No line is shuffled but these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ENDS = "file long, start long, assumed int, ended int, records long, head string, tail string"
RECORDS = "file long, start long, first boolean, record string"

# A field: blanks, then a quoted text with what follows its closing quote, or a text without quotes in front, or nothing. Each
# part can match in one way only, so automata without possessive repeats find the same.
_FIELD = r'[ \t]*(?:"(?:[^"]|"")*"(?:[^",][^,]*)?|[^", \t][^,]*)?'
_FROM_OUTSIDE = f"^{_FIELD}(?:,{_FIELD})*$"
_FROM_INSIDE = rf'^(?:[^"]|"")*"(?:[^",][^,]*)?(?:,{_FIELD})*$'


def turns_of(lines: pa.Array) -> np.ndarray:
    """For each line whether a field is open behind it: in row 0 if none was in front of it, in row 1 if one was."""
    lines = lines.cast(pa.binary())  # bytes, of which only ASCII ones matter
    quoted = pc.find_substring(lines, '"').to_numpy(zero_copy_only=False) >= 0
    out = np.repeat([[False], [True]], len(lines), axis=1)  # lines without quotes leave it as it is
    some = lines.filter(pa.array(quoted))
    for k, closed in enumerate((_FROM_OUTSIDE, _FROM_INSIDE)):
        out[k, quoted] = ~pc.match_substring_regex(some, closed).to_numpy(zero_copy_only=False)
    return out


def open_after(turns: np.ndarray, inside: bool) -> np.ndarray:
    """For each line whether a field is open behind it, if one is in front of the first or not."""
    outside, within = turns
    settled = outside == within
    last = np.maximum.accumulate(np.where(settled, np.arange(len(settled)), -1))
    flips = np.append(0, np.cumsum(outside & ~within))  # [i + 1]: up to line i
    base = np.where(last < 0, inside, outside[last])
    return base ^ ((flips[1:] - flips[last + 1]) % 2 == 1)


def ends_inside(line: str, inside: bool) -> bool:
    """Whether the line ends inside a quoted field, if it begins so or not."""
    return bool(turns_of(pa.array([line]))[int(inside), 0])


def record_ends(turns: np.ndarray, inside: bool) -> tuple[np.ndarray, bool]:
    """For each line whether a record ends with it, and whether the last one ends inside a quoted field."""
    if not turns.shape[1]:
        return np.zeros(0, bool), inside
    after = open_after(turns, inside)
    return ~after, bool(after[-1])


def lines_of(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file (a number), start of the split, line. A file's lines are in order within their split."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.regexp_replace("value", "\r$", "").alias("line"))


def splits_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], Iterator[pa.Array]]]:
    """The splits of a task, one after another, each as the arrays of its lines."""
    pieces = iter(_pieces(batches))
    piece = next(pieces, None)
    while piece is not None:
        key = piece[0]

        def own(key: tuple[int, int] = key) -> Iterator[pa.Array]:
            nonlocal piece
            while piece is not None and piece[0] == key:
                yield piece[1]
                piece = next(pieces, None)

        rows = own()
        yield key, rows
        for _ in rows:  # what the caller left
            pass


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    for batch in batches:
        file, start = (batch.column(i).to_numpy() for i in (0, 1))
        cuts = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            if a < b:
                yield (int(file[a]), int(start[a])), batch.column(2).slice(a, b - a)


def split_ends(lines: DataFrame) -> DataFrame:
    """Of every split, under both assumptions: how it ends, how many records, the lines before the first and after the last."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, start), arrays in splits_in(batches):
            state = [{"inside": bool(k), "records": 0, "head": [], "tail": []} for k in (0, 1)]
            for some in arrays:
                turns = turns_of(some)
                for k, s in enumerate(state):
                    ends, s["inside"] = record_ends(turns, s["inside"])
                    at = np.flatnonzero(ends)
                    if not s["records"] and k:
                        s["head"] += some.slice(0, int(at[0]) + 1 if len(at) else len(some)).to_pylist()
                    if len(at):
                        s["tail"] = []
                    if len(at) or s["records"] or not k:
                        s["tail"] += some.slice(int(at[-1]) + 1 if len(at) else 0).to_pylist()
                    s["records"] += len(at)
            yield pa.RecordBatch.from_pylist([{
                "file": file, "start": start, "assumed": k, "ended": int(s["inside"]), "records": s["records"],
                "head": "\n".join(s["head"]) if k else None, "tail": "\n".join(s["tail"]) if s["tail"] else None} for k, s in enumerate(state)],
                schema=pa.schema([("file", pa.int64()), ("start", pa.int64()), ("assumed", pa.int32()), ("ended", pa.int32()),
                                  ("records", pa.int64()), ("head", pa.string()), ("tail", pa.string())]))

    return lines.mapInArrow(read, ENDS)


def true_ends(ends: DataFrame) -> DataFrame:
    """The row of every split whose assumption is right: its file begins outside, and splits go on as those before them end."""
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    one = ends.groupBy("file", "start").agg(
        F.max(F.when(F.col("assumed") == 0, F.col("ended"))).alias("a"), F.max(F.when(F.col("assumed") == 1, F.col("ended"))).alias("b"))
    turns = one.withColumn("turns", F.sum(F.when(F.col("a") > F.col("b"), 1).otherwise(0)).over(order))
    settled = F.last(F.when(F.col("a") == F.col("b"), F.struct("a", "turns")), True).over(before)
    known = turns.withColumn("s", settled).withColumn("n", F.max("turns").over(before))
    begins = known.select("file", "start", F.pmod(
        F.coalesce("s.a", F.lit(0)) + F.coalesce("n", F.lit(0)) - F.coalesce("s.turns", F.lit(0)), F.lit(2)).cast("int").alias("assumed"))
    return ends.join(begins, ["file", "start", "assumed"])


def across_splits(found: DataFrame) -> DataFrame:
    """The records that lie in several splits: lines after a split's last record and those before the next one's first."""
    part = F.expr("""filter(array(
        CASE WHEN assumed = 1 THEN named_struct('part', 0, 'text', head) END,
        CASE WHEN tail IS NOT NULL THEN named_struct('part', 1, 'text', tail) END), x -> x IS NOT NULL)""")
    rows = found.select("file", "start", "assumed", "records", F.inline(part))
    order = Window.partitionBy("file").orderBy("start", "part")
    numbered = rows.withColumn("n", F.sum("part").over(order)).withColumn(
        "header", (F.col("start") == 0) & (F.col("part") == 1) & (F.col("records") == 0))
    whole = numbered.groupBy("file", "n").agg(
        F.array_sort(F.collect_list(F.struct("start", "part", "text"))).alias("parts"), F.max("header").alias("header"))
    return whole.where("not header").select(F.array_join("parts.text", "\n").alias("record"))


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The records of CSV files with a header line each, as texts without it; line breaks inside quotes are ``\\n``.

    Files are cut into splits like any text; a record may lie in any number of them. Blank lines outside quotes are left out. The
    splits that begin inside quotes, 16 bytes for each, go to every task: at most one per split, of which Spark's driver
    holds the whole list anyway. Files are read twice.
    """
    from gaugeline.session import work_folder

    lines = lines_of(spark, path)
    folder = work_folder(spark, "csv-ends")
    split_ends(lines).write.parquet(folder)
    found = true_ends(spark.read.schema(ENDS).parquet(folder))
    inside = spark.sparkContext.broadcast({(r.file, r.start) for r in found.where("assumed = 1").select("file", "start").collect()})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, arrays in splits_in(batches):
            state = key in inside.value
            # The lines of a record that a split before has begun are not this pass's.
            skip, first, open_ = state, key[1] == 0 and not state, []
            for some in arrays:
                ends, state = record_ends(turns_of(some), state)
                at = np.flatnonzero(ends)
                if not len(at):
                    open_ += [] if skip else some.to_pylist()
                    continue
                begin, texts = 0, []
                if skip or open_:
                    begin = int(at[0]) + 1
                    texts = [] if skip else ["\n".join([*open_, *some.slice(0, begin).to_pylist()])]
                    skip, open_, at = False, [], at[1:]
                done = int(at[-1]) + 1 if len(at) else begin
                offsets = np.append(0, at + 1 - begin).astype("i4")
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), some.slice(begin, done - begin)), "\n")
                out = pa.concat_arrays([pa.array(texts, joined.type), joined])
                open_ = some.slice(done).to_pylist()
                if first and len(out):
                    out, first = out.slice(1), False
                yield pa.RecordBatch.from_arrays([out], names=["record"])

    within = lines.mapInArrow(cut, "record string")
    return within.unionByName(across_splits(found)).where("record <> ''")
