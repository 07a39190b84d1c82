"""CSV records of files of any size, read by many tasks (S3).

Spark's text reader cuts a file into blocks of lines, but a quoted field may
hold line breaks, so a block does not know whether it starts inside quotes.
A first pass finds, for both answers, where every block would end; composing
these per file gives the state at each block's start; a second pass then cuts
the blocks into records.  Records that cross a block bound are put together
from their pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A longer record is a malformed one (an unclosed quote would swallow the file).
MAX_RECORD = 32 << 20
PIECE = "file string, block long, outside boolean, inside boolean, header string"
RECORD = "file string, block long, layout string, part int, record string, whole boolean, head boolean"


def quoted_after(line: str, inside: bool) -> bool:
    """Whether a line that starts inside (or outside) quotes ends inside them.
    Only a quote at the start of a field opens, a doubled one stands for itself."""
    at, field = 0, not inside
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('""', at):
                at += 2
            else:
                inside, field, at = False, False, at + 1
        elif field and line.startswith('"', at):
            inside, at = True, at + 1
        else:
            at = line.find(",", at) + 1
            if not at:
                return False
            field = True


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"))


def _blocks_of(batches) -> Iterator[tuple[str, int, list[str], bool]]:
    """(file, block, lines, whether the block ends here) in reading order."""
    held = None
    for batch in batches:
        file, block, value = (batch.column(i).to_pylist() for i in range(3))
        start = 0
        for i in range(1, len(file) + 1):
            if i == len(file) or file[i] != file[start] or block[i] != block[start]:
                if held is not None:
                    yield *held, held[:2] != (file[start], block[start])
                held = (file[start], block[start], value[start:i])
                start = i
    if held is not None:
        yield *held, True


def _states(batches):
    import pyarrow as pa
    state, header = {False: False, True: True}, None
    for file, block, lines, last in _blocks_of(batches):
        if header is None:
            header = lines[0] if block == 0 and lines else ""
        for line in lines:
            if '"' in line:
                state = {a: quoted_after(line, b) for a, b in state.items()}
            else:  # a line without quotes ends as it starts
                pass
        if last:
            yield pa.RecordBatch.from_pylist([{"file": file, "block": block, "outside": state[False],
                                               "inside": state[True], "header": header.rstrip("\r").lstrip("\ufeff")}])
            state, header = {False: False, True: True}, None


def block_states(spark: SparkSession, path: str) -> DataFrame:
    """One row per block: file, block, quoted (whether it starts inside quotes)
    and layout (the file's header line).  A block's effect is a constant or the
    identity or a swap: the last constant before a block and the swaps since
    then give its state."""
    pieces = _lines(spark, path).mapInArrow(_states, PIECE)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    constant = F.col("outside") == F.col("inside")
    swap = F.when(~constant & F.col("outside"), 1).otherwise(0)
    numbered = pieces.withColumn("swaps", F.sum(swap).over(
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    fixed = F.last(F.when(constant, F.struct("outside", "swaps")), ignorenulls=True).over(before)
    numbered = numbered.withColumn("fixed", fixed).withColumn("so_far", F.coalesce(F.lag("swaps").over(
        Window.partitionBy("file").orderBy("block")), F.lit(0)))
    odd = (F.col("so_far") - F.coalesce("fixed.swaps", F.lit(0))) % 2 == 1
    first = F.first("header").over(Window.partitionBy("file").orderBy("block"))
    return numbered.select("file", "block", (F.coalesce("fixed.outside", F.lit(False)) != odd).alias("quoted"),
                           first.alias("layout"))


def _cut(longest):
    """Records of the blocks: part 0 is a record that starts and ends in its
    block, 1 the end of one that an earlier block began, 2 the beginning of one
    that goes on, 3 a block that is all inside one."""
    def run(batches):
        import pyarrow as pa
        quoted, layout, open_, size, lines_of, first = {}, None, None, 0, None, True

        def row(file, block, part, text, whole=True, head=False):
            return {"file": file, "block": block, "layout": layout, "part": part, "record": text, "whole": whole, "head": head}

        def flagged():
            for batch in batches:
                names = batch.schema.names
                quoted.update(zip(zip(batch.column(names.index("file")).to_pylist(),
                                      batch.column(names.index("block")).to_pylist(), strict=True),
                                  zip(batch.column(names.index("quoted")).to_pylist(),
                                      batch.column(names.index("layout")).to_pylist(), strict=True), strict=True))
                yield batch

        start = True
        inside, begun = False, False
        for file, block, lines, last in _blocks_of(flagged()):
            out = []
            if start:
                inside, layout = quoted[file, block]
                begun = inside  # the open record began in an earlier block
                open_, size, start, first = ([], 0, False, block == 0)
            for line in lines:
                line = line[:-1] if line.endswith("\r") else line
                head, first = first, False
                line = line.lstrip("\ufeff") if head else line
                was, inside = inside, (quoted_after(line, inside) if '"' in line else inside)
                if not was and not inside and not open_ and not begun:
                    if line:
                        out.append(row(file, block, 0, line, head=head))
                    continue
                size += len(line) + 1
                if size <= longest:
                    open_.append(line)
                if not inside:
                    out.append(row(file, block, 1 if begun else 0, "\n".join(open_), size <= longest))
                    open_, size, begun = [], 0, False
            if last:
                if open_ or size or (begun and inside):
                    out.append(row(file, block, 3 if begun else 2, "\n".join(open_), size <= longest))
                start = True
                quoted.pop((file, block), None)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                    ("file", pa.string()), ("block", pa.int64()), ("layout", pa.string()), ("part", pa.int32()),
                    ("record", pa.string()), ("whole", pa.bool_()), ("head", pa.bool_())]))
    return run


def csv_records(spark: SparkSession, path: str, longest: int | None = None) -> DataFrame:
    """(file, layout, record, whole, head): every record of the CSV files under
    ``path``; ``head`` marks a file's header, ``whole`` is false where a record is longer than ``longest`` characters, of which the first are kept.

    A file is cut at the session's ``maxPartitionBytes``.  The block table has
    one short row per block of input and is broadcast; rows are never shuffled
    but for the pieces of records that cross a block bound, at most two per
    block.  Line ends are LF or CR LF; inside quotes both become LF."""
    longest = longest or MAX_RECORD
    blocks = block_states(spark, path)
    parts = (_lines(spark, path).join(F.broadcast(blocks), ["file", "block"])
             .select("file", "block", "value", "quoted", "layout").mapInArrow(_cut(longest), RECORD)).checkpoint(eager=True)
    pieces = parts.where("part > 0")
    # A record begins at a part 2; the parts after it, up to the next one, are its rest.
    nth = F.sum(F.when(F.col("part") == 2, 1).otherwise(0)).over(
        Window.partitionBy("file").orderBy("block", F.when(F.col("part") == 2, 1).otherwise(0)))
    size = F.sum(F.length("record") + 1).over(Window.partitionBy("file", "nth").orderBy("block"))
    kept = (pieces.withColumn("nth", nth).withColumn("size", size)
            .withColumn("fits", (F.col("size") <= longest) & F.col("whole")))
    across = (kept.groupBy("file", "layout", "nth").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("fits"), F.struct("block", "record")))),
                                 lambda x: x["record"]), "\n").alias("record"), F.min("fits").alias("whole")))
    return (parts.where("part = 0").select("file", "layout", "record", "whole", "head")
            .unionByName(across.select("file", "layout", "record", "whole", F.lit(False).alias("head"))))
