"""Exact duplicates and key uniqueness.

Duplicates are looked for by fingerprint: 128 bits of each row are counted first, combined map-side, and only rows whose
fingerprint occurs more than once are moved and compared in full. A false match costs a comparison, never a result.

Counting moves no row where each column's type has a text that tells all its values apart: rows are compared by a SHA-256 of
their text, 32 bytes a row. Where very many fingerprints repeat, nearly every row has to move to be dropped; each then moves
once, to a number of tasks that grows with the rows.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from daybrook.session import materialize

PRINT = ("_print_1", "_print_2")
# 16-byte fingerprints, counted first, up to which the repeated ones are sent to all tasks; beyond, rows are shuffled by fingerprint
BROADCAST_PRINTS = 500_000
# rows that one task compares in full, and copies from which on a row is combined where it is read
ROWS_PER_TASK, MANY_COPIES = 250_000, 25_000
# bits of a row's place that number it within its file, within a bitmap and within a word of that
ROW_BITS, BLOCK_BITS, WORD_BITS = 34, 13, 6
# rows of a stored table whose bits are sent to all tasks at once (64 MB)
MARKED_AT_ONCE = 500_000_000
# types whose text is equal for equal values only
EXACT_TEXT = (T.StringType, T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.BooleanType, T.DateType)


def fingerprint(columns) -> list[Column]:
    """Two 64-bit hashes of a row. Null is told from every value by its place."""
    parts = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return [F.xxhash64(F.lit(seed), *order).alias(name) for seed, order, name in ((1, parts, PRINT[0]), (2, parts[::-1], PRINT[1]))]


def _counted_prints(df: DataFrame) -> DataFrame:
    """(fingerprint, n) of more than one row, stored: two numbers a row are all that is shuffled for the others."""
    prints = df.select(*fingerprint(df.columns))
    return materialize(prints.groupBy(*PRINT).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated-prints")


def repeated_prints(df: DataFrame) -> DataFrame:
    """The fingerprints of more than one row."""
    return _counted_prints(df).select(*PRINT)


def has_exact_text(df: DataFrame) -> bool:
    """Every column has a type of ``EXACT_TEXT``, and text is compared byte by byte."""
    return all(type(f.dataType) in EXACT_TEXT and (type(f.dataType) is not T.StringType or f.dataType == T.StringType())
               for f in df.schema.fields)


def digest(columns) -> Column:
    """SHA-256 of a row's text, 32 bytes. The lengths behind the cells tell them apart, -1 stands for null."""
    cells = [F.col(f"`{c}`").cast("string") for c in columns]
    lengths = [F.coalesce(F.octet_length(x), F.lit(-1)).cast("string") for x in cells]
    return F.unhex(F.sha2(F.concat_ws(",", *cells, *lengths), 256))


def _side(prints: DataFrame, count: int) -> DataFrame:
    return F.broadcast(prints) if count <= BROADCAST_PRINTS else prints


def maybe_repeated(df: DataFrame) -> DataFrame:
    """The rows whose fingerprint occurs more than once."""
    prints = repeated_prints(df)
    return df.select("*", *fingerprint(df.columns)).join(_side(prints, prints.count()), list(PRINT), "left_semi").select(*_named(df))


def _named(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def _tasks(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_TASK))


def _drop_many(df: DataFrame, prints: DataFrame) -> DataFrame:
    """Distinct rows where most rows have to move. Rows meet by fingerprint, in as many tasks as their number asks for.

    Rows are not combined before they move, which would hold all rows of a task. Only rows with very many copies are: they
    are few different ones, and one task would read all copies.
    """
    rows = df.select("*", *fingerprint(df.columns))
    many = prints.where(F.col("n") >= MANY_COPIES).select(*PRINT)
    hot = None
    if not many.isEmpty():  # at most one in ``MANY_COPIES`` rows
        hot = rows.join(F.broadcast(many), list(PRINT), "left_semi").select(*_named(df)).dropDuplicates()
        rows = rows.join(F.broadcast(many), list(PRINT), "left_anti")
    rest = rows.repartition(_tasks(df.count()), *PRINT).dropDuplicates().select(*_named(df))
    return rest if hot is None else rest.unionByName(hot)


def _firsts_where_read(df: DataFrame) -> DataFrame:
    """Distinct rows of a stored Parquet table; no row moves.

    A row's digest and its place, (file, number in it), are all that is shuffled. The first place of each digest is kept: one bit
    a row, gathered to a bitmap for each 2 ** ``BLOCK_BITS`` rows of a file. The table is read again beside its bitmaps, in rounds of
    files if there are more than fit into a broadcast.
    """
    meta = df.metadataColumn("_metadata")
    taken = {c.lower() for c in df.columns}
    file, at, block, words = (next(n for n in (base + "_" * k for k in range(99)) if n not in taken)
                              for base in ("_file", "_at", "_block", "_words"))
    found = df.groupBy(meta["file_path"].alias(file)).agg(F.max(meta["row_index"]).alias("_last"))
    number = F.row_number().over(Window.orderBy(file)).cast("bigint")  # one short row a file
    files = materialize(found.select(file, number.alias("_number"), "_last"), "files")
    rows = files.select(F.coalesce(F.sum(F.col("_last") + 1), F.lit(0))).first()[0]
    rounds = max(1, -(-rows // MARKED_AT_ONCE))

    places = df.select(digest(df.columns).alias("_digest"), meta["file_path"].alias(file), meta["row_index"].alias("_row")).join(
        F.broadcast(files), file).select("_digest", (F.shiftleft("_number", ROW_BITS) + F.col("_row")).alias("_place"))
    first = places.groupBy("_digest").agg(F.min("_place").alias("_place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("_place") % 64).cast("int"))
    of_word = first.groupBy(F.shiftright("_place", WORD_BITS).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    per_block = 1 << (BLOCK_BITS - WORD_BITS)
    listed = of_word.groupBy(F.shiftright("_word", BLOCK_BITS - WORD_BITS).alias("_part")).agg(F.map_from_entries(
        F.collect_list(F.struct((F.col("_word") % per_block).cast("int").alias("k"), "_bits"))).alias("_of"))
    every = F.transform(F.sequence(F.lit(0), F.lit(per_block - 1)), lambda k: F.coalesce(F.try_element_at("_of", k), F.lit(0).cast("bigint")))
    marks = materialize(listed.select(
        F.shiftright("_part", ROW_BITS - BLOCK_BITS).alias("_number"), (F.col("_part") % (1 << (ROW_BITS - BLOCK_BITS))).alias(block),
        every.alias(words)).join(F.broadcast(files), "_number").select(file, "_number", block, words), "marks")

    whole = df.select("*", meta["file_path"].alias(file), meta["row_index"].alias(at)).withColumn(block, F.shiftright(at, BLOCK_BITS))
    in_block = (F.col(at) % (1 << BLOCK_BITS)).cast("int")
    kept = F.getbit(F.get(words, F.shiftright(in_block, WORD_BITS)), in_block % 64) == 1
    parts = [whole.join(F.broadcast(marks.where(F.col("_number") % rounds == k).drop("_number")), [file, block]).where(kept)
             for k in range(rounds)]
    return reduce(DataFrame.unionByName, [x.select(*_named(df)) for x in parts])


def drop_exact_duplicates(df: DataFrame, stored=False) -> DataFrame:
    """Distinct rows over all columns, compared as they are (text stays text: ``20.0`` is not ``20.00``).

    ``stored``: ``df`` is a Parquet table as it was read, so that a row is told by its place. Where its types have exact texts,
    equal digests count as equal rows and no row moves.

    Otherwise rows without a double stay where they are read. Where too many fingerprints repeat to be sent to all tasks, every
    row has to move anyway and does so once. ``df`` is read more than once: pass a stored table.
    """
    if stored and has_exact_text(df):
        return _firsts_where_read(df)
    counted = _counted_prints(df)
    if counted.count() > BROADCAST_PRINTS:
        return _drop_many(df, counted)
    prints = counted.select(*PRINT)
    rows = df.select("*", *fingerprint(df.columns))
    alone = rows.join(F.broadcast(prints), list(PRINT), "left_anti").select(*_named(df))
    several = rows.join(F.broadcast(prints), list(PRINT), "left_semi").select(*_named(df))
    return alone.unionByName(several.dropDuplicates())


def _surplus(df: DataFrame, by: list) -> DataFrame:
    """Rows beyond one of each, per group of ``by``."""
    groups = [F.col(f"`{c}`") for c in by]
    if has_exact_text(df):
        copies = df.select(*groups, digest(df.columns).alias("_row")).groupBy(*groups, "_row").agg(F.count(F.lit(1)).alias("_copies"))
    else:
        prints = repeated_prints(df)
        rows = df.select("*", *fingerprint(df.columns)).join(_side(prints, prints.count()), list(PRINT), "left_semi")
        # grouped by the fingerprint too, rows that moved by it do not move again
        copies = rows.groupBy(*PRINT, *_named(df)).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.where("_copies > 1").groupBy(*groups).agg(F.sum(F.col("_copies") - 1).alias("exact_duplicate_rows"))


def duplicate_stats(df: DataFrame, by=()) -> DataFrame:
    """Rows, distinct rows, exact duplicates and their share, per group of ``by`` (whole table if empty).

    ``df`` is read more than once: pass a stored table.
    """
    by = list(by)
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))
    surplus = _surplus(df, by)
    if by:
        same = reduce(lambda x, y: x & y, [F.col(f"s.`{c}`").eqNullSafe(F.col(f"c.`{c}`")) for c in by])
        joined = counted.alias("c").join(surplus.alias("s"), same, "left").select(
            *[F.col(f"c.`{c}`") for c in by], "n_rows", "exact_duplicate_rows")
    else:
        joined = counted.withColumn("exact_duplicate_rows", surplus.scalar())
    extra = F.coalesce("exact_duplicate_rows", F.lit(0))
    return joined.select(
        *by, "n_rows", (F.col("n_rows") - extra).alias("distinct_rows"), extra.alias("exact_duplicate_rows")
    ).withColumn("exact_duplicate_share", F.try_divide(
        F.col("exact_duplicate_rows").cast("double"), F.col("n_rows").cast("double")))


def duplicate_keys(df: DataFrame, key, by=()) -> DataFrame:
    """Keys that occur more than once and the surplus rows."""
    cols = list(dict.fromkeys(list(by) + list(key)))
    return (
        df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1").withColumn("surplus", F.col("n") - 1)
    )
