"""CSV records that span lines, read in any number of tasks per file.

A line of a file may begin inside a quoted field, which only the text before
it tells. Each split is therefore scanned for both cases: a two-state automaton
(outside or inside quotes) gives the state after the split for either state
before it. These maps, one per split, are composed in the order of each file;
then every split is cut into records with its true first state. What a record
has in later splits is put behind it by the number of the split it began in.
"""

from __future__ import annotations

import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import cut_lineage, ship_package

OUTSIDE, INSIDE = 0, 1
#: Bytes that a task scans at least, in any number of splits, once there are TASKS_PER_CORE tasks a core.
TASK_BYTES, TASKS_PER_CORE = 32 << 20, 4


def state_after(line: str, state: int, sep: str = ",") -> int:
    """State after a line: a quote opens a field only at the field's start;
    inside, a doubled quote is a character."""
    at, n = 0, len(line)
    if state == OUTSIDE and '"' not in line:
        return OUTSIDE
    while True:
        if state == OUTSIDE:
            if at == 0 and line[:1] == '"':
                at = 1
            else:  # the next field that begins with a quote
                found = line.find(sep + '"', at)
                if found < 0:
                    return OUTSIDE
                at = found + len(sep) + 1
            state = INSIDE
        else:
            at = line.find('"', at)
            if at < 0:
                return INSIDE
            if line[at + 1 : at + 2] == '"':
                at += 2
            else:
                at += 1
                state = OUTSIDE
                if at >= n:
                    return OUTSIDE


def _by_split(batches):
    """(file, split, lines) for each stretch of lines of a split."""
    for b in batches:
        files, starts, lines = b.column("file").to_pylist(), b.column("split").to_pylist(), b.column("value").to_pylist()
        lo = 0
        for hi in range(1, len(lines) + 1):
            if hi == len(lines) or (files[hi], starts[hi]) != (files[lo], starts[lo]):
                yield files[lo], starts[lo], lines[lo:hi]
                lo = hi


def _maps(sep: str):
    """For each split the state after it, from either state before it."""
    def run(batches):
        found: dict = {}
        for file, start, lines in _by_split(batches):
            states = found.get((file, start), (OUTSIDE, INSIDE))
            for line in lines:
                states = tuple(state_after(line, s, sep) for s in states)
            found[file, start] = states
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in found]), pa.array([k[1] for k in found], pa.int64()), pa.array([v[0] for v in found.values()], pa.int32()),
                 pa.array([v[1] for v in found.values()], pa.int32())], ["file", "split", "from_out", "from_in"])
    return run


_PART = "file string, split long, place long, head boolean, text string"


def _records(first: dict, sep: str):
    """Records that begin in a split, without what later splits hold of the last;
    head: the lines before the split's first record, which belong to one that began earlier."""
    def run(batches):
        rows, now, state, held, place, head = [], None, OUTSIDE, None, 0, False

        def close():
            if held is not None:
                rows.append((*now, place, head, "\n".join(held)))

        def frame():
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split()[0] for f in _PART.split(", ")])

        for file, start, lines in _by_split(batches):
            if (file, start) != now:
                close()
                now, state, held, place = (file, start), first[file, start], None, 0
            for line in lines:
                if state == INSIDE:
                    if held is None:
                        held, head = [], True
                    held.append(line)
                else:
                    close()
                    place += held is not None
                    held, head = [line], False
                state = state_after(line, state, sep)
                if len(rows) >= 10_000:
                    yield frame()
                    rows.clear()
        close()
        if rows:
            yield frame()
    return run


def in_few_tasks(lines: DataFrame) -> DataFrame:
    """The lines with several splits in a task where splits are small: each would cost a task's start."""
    spark, splits = lines.sparkSession, lines.rdd.getNumPartitions()
    size, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower()).groups()
    whole = splits * int(size) * 1024 ** " kmgtp".index(unit or " ")
    tasks = max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, -(-whole // TASK_BYTES))
    return lines.coalesce(tasks) if tasks < splits else lines


def read_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """value, file, split of every line (ended by a line feed), in the order of the file inside a split."""
    df = spark.read.option("lineSep", "\n").text(path)
    value = F.col("value")
    if encoding.replace("-", "").upper() != "UTF8":
        value = F.decode(value.cast("binary"), encoding)
    return df.select(value.alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))


def may_span_lines(lines: DataFrame, sep: str = ",") -> bool:
    """False only if no record can span lines: every line has an even number
    of quotes, and each quote stands at an edge of a field or beside another."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"')))
    edge = "[\\r\"" + ("\\" + sep if not sep.isalnum() else sep) + "]"
    loose = F.regexp_replace("value", f'^"|"$|(?<={edge})"|"(?={edge})', "").contains('"')
    return bool(in_few_tasks(lines).where(F.col("value").contains('"') & ((quotes % 2 == 1) | loose)).limit(1).count())


def read_records(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """The CSV files at `path` (each with a header line) as columns of text.

    Quoted fields may hold line breaks, separators and doubled quotes. A file
    whose last field is never closed raises."""
    ship_package(spark)
    lines = in_few_tasks(read_lines(spark, path, encoding))
    maps = lines.mapInArrow(_maps(sep), "file string, split long, from_out int, from_in int").collect()  # one row per split
    first, by_file = {}, defaultdict(list)
    for r in maps:
        by_file[r["file"]].append((r["split"], r["from_out"], r["from_in"]))
    for file, splits in by_file.items():
        splits.sort()
        state = OUTSIDE
        for start, from_out, from_in in splits:
            first[file, start] = state
            state = from_in if state == INSIDE else from_out
        if state == INSIDE:
            raise ValueError(f"{file} ends inside a quoted field")
    parts = cut_lineage(lines.mapInArrow(_records(first, sep), _PART))
    # pieces of a record: the last record of the split it began in, and the heads of the splits after it
    heads = parts.where("head")
    ends = {(r["file"], r["split"]) for r in heads.select("file", "split").collect()}  # at most one per split
    last = {(r["file"], r["split"]): r["last"] for r in parts.where("not head").groupBy("file", "split").agg(F.max("place").alias("last")).collect()}
    glue: dict = {}
    for file, splits in by_file.items():
        began = None  # the last record begun so far
        for start, *_ in splits:
            if (file, start) in ends and began is not None:
                glue[file, start] = began
            if (file, start) in last:
                began = (start, last[file, start])
    table = spark.createDataFrame([(f, s, b, p) for (f, s), (b, p) in glue.items()], "file string, split long, to_split long, to_place long")
    tails = heads.join(F.broadcast(table), ["file", "split"]).groupBy("file", "to_split", "to_place").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("split", "text"))), lambda x: x["text"]), "\n").alias("tail"))
    whole = parts.where("not head").join(
        F.broadcast(tails.withColumnsRenamed({"to_split": "split", "to_place": "place"})), ["file", "split", "place"], "left")  # at most one per split
    record = F.regexp_replace(F.concat_ws("\n", "text", "tail"), "\r$", "")
    whole = whole.select("file", "split", "place", record.alias("record"))
    begins = {file: splits[0][0] for file, splits in by_file.items()}
    if not begins:
        return spark.createDataFrame([], T.StructType())
    at = spark.createDataFrame(list(begins.items()), "file string, begin long")
    header = (F.col("split") == F.col("begin")) & (F.col("place") == 0)
    whole = whole.join(F.broadcast(at), "file")
    options = {"sep": sep, "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "maxCharsPerColumn": "-1"}
    names = _names(spark, whole.where(header & (F.col("file") == min(begins))).first()["record"].lstrip("\ufeff"), options)
    body = whole.where(~header & (F.col("record") != ""))
    return body.select(F.from_csv("record", ", ".join(f"`{n.replace('`', '``')}` string" for n in names), options).alias("r")).select("r.*")


def _names(spark: SparkSession, header: str, options: dict) -> list[str]:
    """Column names of a header record, by the same parser as the data."""
    width = header.count(options["sep"]) + 1
    row = spark.createDataFrame([(header,)], "h string").select(F.from_csv("h", ", ".join(f"c{i} string" for i in range(width)), options).alias("r")).first()["r"]
    names = list(row)
    while len(names) > 1 and names[-1] is None:
        names.pop()
    names = [n if n is not None else f"_c{i}" for i, n in enumerate(names)]
    twice = {n.lower() for n in names if [m.lower() for m in names].count(n.lower()) > 1}
    return [f"{n}{i}" if n.lower() in twice else n for i, n in enumerate(names)]  # as Spark's reader names them
