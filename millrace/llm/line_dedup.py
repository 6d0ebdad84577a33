"""Repeated lines across documents by a deletion-neighbourhood join; built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from millrace.functions.columns import quoted
from millrace.llm.common import Workspace, columns, fresh_column
from millrace.operators.joins import fits_in_every_task

# A line of fewer words is dropped only if equal to an earlier one; others also at one word's difference.
MIN_NEAR_WORDS = 10
BLANKS = " \t\r\f\x0b"
# ``monotonically_increasing_id`` has the place within the task in its low bits.
_TASK_BITS = 33
# Places that each document id has for the lines of its rows.
_ROOM = 2**62
# Rows that lose lines are told from others by so many bits, in bitmaps of 2^15 bits.
_FILTER_BITS, _BITMAP = 27, 2**15
# Keys that stand in a table are told from others by so many bits, in longs.
_SIEVE_BITS = 26
# The lines that rows lose go to every task up to this size, so that no text is moved.
_REPLICATED_BYTES = 64 * 1024 * 1024


def _words(line: Column) -> Column:
    """Lower-cased words of a line that has words, parted by ASCII blanks."""
    return F.split(F.btrim(F.lower(line), F.lit(BLANKS)), f"[{BLANKS}]+")


def _numbered(docs: DataFrame, row: str, id_col: str, text_col: str, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """``docs`` with a number per row, and (row, head, text) of it; the head is the place of the row's first line.

    Places order rows by document id, null first, then by row; those of two rows do not meet. Where ids are all different
    they number the rows themselves, spread by the most lines a row has, if their span fits a long. Otherwise the rows are
    staged with a number each (task and place in the task), which comes behind the id, in a decimal.
    """
    named = lambda df: columns(df, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast(T.StringType()))
    line_count = F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    # Bytes are known without counting, and are as many as lines at least.
    most, rows, ids, different, low, high = named(docs).select(
        F.max(F.octet_length("text")), F.count(F.lit(1)), F.count("doc_id"), F.count_distinct("doc_id"), F.min("doc_id"), F.max("doc_id")
    ).first()
    most, low, high = (most or 0) + 1, low or 0, high or 0
    single = ids == different and rows - ids <= 1 and low > -(2**62)
    if single and high - low + 2 <= _ROOM < (high - low + 2) * most:
        most = named(docs).select(F.max(line_count)).first()[0] or 1
    if single and (high - low + 2) * most <= _ROOM:
        number = F.coalesce(F.col("doc_id"), F.lit(low - 1))
        numbered = docs.withColumn(row, F.coalesce(quoted(id_col).cast("long"), F.lit(low - 1)))
        return numbered, named(docs).select(number.alias("row"), ((number - low + 1) * most).cast("long").alias("head"), "text")
    numbered = work.stage(docs.withColumn(row, F.monotonically_increasing_id()))
    task, at = F.shiftright(row, _TASK_BITS), F.col(row).bitwiseAND(2**_TASK_BITS - 1)
    tasks, size = numbered.select(F.max(task) + 1, F.max(at) + 1).first()
    size, most = size or 1, named(numbered).select(F.max(line_count)).first()[0] or 1
    if (tasks or 1) * size * most > _ROOM:
        raise ValueError(f"{tasks} tasks of {size} rows of {most} lines have more places than {_ROOM}")
    source = columns(numbered, row=row, doc_id=id_col, text=text_col)
    task, at = F.shiftright("row", _TASK_BITS), F.col("row").bitwiseAND(2**_TASK_BITS - 1)
    whole = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).cast("decimal(20,0)") * F.lit(_ROOM).cast("decimal(19,0)")
    # A whole product has 38 digits at most, -2^125.
    head = (whole + ((task * size + at) * most).cast("decimal(19,0)")).cast("decimal(38,0)")
    return numbered, source.select("row", head.alias("head"), F.col("text").cast(T.StringType()).alias("text"))


def _lines(docs: DataFrame) -> DataFrame:
    """row, place, line_no, words of every line that has words, in (row, head, text)."""
    place = F.col("head") + F.col("line_no")
    return (
        docs.select("row", "head", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
        .where(F.length(F.btrim("line", F.lit(BLANKS))) > 0)
        .select("row", place.cast(docs.schema["head"].dataType).alias("place"), "line_no", _words(F.col("line")).alias("words"))
    )


def _line_keys(words: Column) -> tuple[Column, Column]:
    """Two hashes that together stand for the words of a line."""
    return F.xxhash64(words).alias("k1"), F.xxhash64(F.lit(1), words).alias("k2")


def _half_keys(words: Column, n: Column) -> dict[str, Column]:
    """Hashes that two lines one word apart must share at least one of.

    The difference lies in the first or the second half of the shorter line, so the other half is
    equal, counted from the start or from the end. A line is the shorter (or equal) one in a pair
    of n, the longer one in a pair of n - 1; one of the two halves is the same in both, so three of the four
    hashes differ.
    """
    keys = {}
    for role, size in (("own", n), ("less", n - 1)):
        half = F.floor(size / 2).cast("int")
        rest = (size - half).cast("int")
        keys[f"start_{role}"] = F.xxhash64(F.lit("start"), half, F.slice(words, F.lit(1), half))
        keys[f"end_{role}"] = F.xxhash64(F.lit("end"), rest, F.slice(words, n - rest + 1, rest))
    return keys


def _variants(candidates: DataFrame) -> DataFrame:
    """variant (hash), place, full: the deletion neighbourhood of every line of (place, words).

    A line with one word masked meets lines that differ in that word; a line with one word deleted
    meets the line that lacks it, which sends its own hash (full). Words are hashed with their
    places and joined by xor, so that running values give every variant in one pass.
    """
    n = F.size("words")
    # dealt by line before they are taken apart, the words of a line need no further shuffle for the windows
    rows = candidates.repartition("place").select("place", n.alias("n"), F.posexplode("words").alias("i", "word"))
    rows = rows.select("place", "n", "i", F.xxhash64("word", "i").alias("here"), F.xxhash64("word", F.col("i") - 1).alias("moved"))
    line = Window.partitionBy("place")
    so_far = line.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.select(
        "place", "n", "i", "here", F.bit_xor("here").over(so_far).alias("to_here"), F.bit_xor("moved").over(so_far).alias("to_moved"),
        F.bit_xor("here").over(line).alias("all_here"), F.bit_xor("moved").over(line).alias("all_moved"),
    )
    before = F.col("to_here").bitwiseXOR(F.col("here"))
    after = F.col("all_moved").bitwiseXOR(F.col("to_moved"))
    kinds = F.array(
        F.struct(F.xxhash64(F.lit("masked"), "n", "i", F.col("all_here").bitwiseXOR(F.col("here"))).alias("variant"), F.lit(None).cast("boolean").alias("full")),
        F.struct(F.xxhash64(F.lit("text"), F.col("n") - 1, before.bitwiseXOR(after)).alias("variant"), F.lit(False).alias("full")),
        F.when(F.col("i") == 0, F.struct(F.xxhash64(F.lit("text"), "n", "all_here").alias("variant"), F.lit(True).alias("full"))),
    )
    return summed.select("place", F.explode(kinds).alias("v")).where("v is not null").select("v.variant", "place", "v.full")


def _one_word_apart(a: Column, b: Column) -> Column:
    """Whether two word lists differ by one word replaced, inserted or deleted at most."""
    longest, shortest = F.greatest(F.size(a), F.size(b)), F.least(F.size(a), F.size(b))

    def shared(x: Column, y: Column) -> Column:
        first = F.array_position(F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False))), False)
        return F.when(first > 0, first - 1).otherwise(shortest)

    return (longest - shortest <= 1) & (shared(a, b) + shared(F.reverse(a), F.reverse(b)) >= longest - 1)


def _sieved(df: DataFrame, key: str, named: DataFrame, named_key: str | None = None) -> DataFrame:
    """``df`` without most of the rows whose ``key`` is not in ``named``; no row that has one there goes.

    Bits of the keys' hashes stand in longs, a million at most, that go to every task. The more keys there are the more
    others share their bits; these rows are then moved for nothing in the join that follows.
    """
    slot = lambda c: F.xxhash64(c).bitwiseAND(2**_SIEVE_BITS - 1)
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), slot(c).bitwiseAND(63).cast("int"))
    block, bits, named_key = fresh_column(df, "block"), fresh_column(df, "bits"), named_key or key
    longs = named.groupBy(F.shiftright(slot(named_key), 6).alias(block)).agg(F.bit_or(bit(named_key)).alias(bits))
    met = df.join(F.broadcast(longs), F.shiftright(slot(key), 6) == F.col(block))
    return met.where(F.col(bits).bitwiseAND(bit(key)) != 0).select(*df.columns)


def _near_lines(first: DataFrame, docs: DataFrame, work: Workspace) -> DataFrame:
    """place, k1, k2 of every distinct line that an earlier line is one word apart from."""
    # Every distinct line has a place of its own.
    halves = F.array_distinct(F.array("start_own", "end_own", "start_less", "end_less"))
    keyed = first.where(F.col("n") >= MIN_NEAR_WORDS).select(F.explode(halves).alias("half"), "place")
    shared = work.stage(keyed.groupBy("half").agg(F.min("place").alias("lo"), F.max("place").alias("hi")).where("lo != hi").select("half"))
    places = work.stage(_sieved(keyed, "half", shared).join(shared, "half").select("place").distinct())
    wanted = F.broadcast(places) if fits_in_every_task(places) else places
    candidates = work.stage(_lines(docs).select("place", "words").join(wanted, "place"))

    variants = work.stage(_variants(candidates))
    groups = work.stage(variants.groupBy("variant").agg(
        F.count(F.lit(1)).alias("lines"), F.min(F.expr("if(full is null, place, null)")).alias("masked_first"),
        F.min(F.expr("if(full, place, null)")).alias("text"), F.min(F.expr("if(not full, place, null)")).alias("longer_first"),
    ).where("lines > 1").drop("lines"))
    # An equally long line one word off, an earlier line without the word, an earlier line with one more.
    meets = _sieved(variants, "variant", groups).join(groups, "variant").select(
        "place", F.expr("case when full is null then masked_first when full then longer_first else text end").alias("earlier")
    )
    edges = work.stage(meets.where("earlier < place").distinct())
    work.drop(shared, places, variants, groups)
    left = _sieved(candidates, "place", edges).withColumnRenamed("words", "own")
    right = _sieved(candidates, "place", edges, "earlier").select(F.col("place").alias("earlier"), F.col("words").alias("other"))
    verified = edges.join(left, "place").join(right, "earlier").where(_one_word_apart(F.col("own"), F.col("other")))
    near = work.stage(verified.select("place", *_line_keys(F.col("own"))).distinct())
    work.drop(candidates, edges)
    return near


def _listed(numbered: DataFrame, row: str, named: DataFrame, named_row: str, listed: str) -> DataFrame:
    """``numbered`` with ``listed``: false for rows that are certainly not in ``named``.

    The rows of ``named`` set bits by hash, in bitmaps that together have 16 MB at most and go to every task. The more
    rows there are the more others share their bits; they are then looked up for nothing, and lose nothing.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(2**_FILTER_BITS))
    block, bit = (fresh_column(numbered, c) for c in ("block", "bits"))
    place = lambda c: slot(c).bitwiseAND(_BITMAP - 1)
    bitmaps = named.groupBy(F.floor(slot(F.col(named_row)) / _BITMAP).alias(block)).agg(F.bitmap_construct_agg(place(F.col(named_row))).alias(bit))
    with_bits = numbered.join(F.broadcast(bitmaps.withColumnRenamed(block, f"{block}_of")), F.floor(slot(F.col(row)) / _BITMAP) == F.col(f"{block}_of"), "left")
    at = place(F.col(row))
    byte = F.conv(F.hex(F.substring(F.col(bit), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    return with_bits.select(*[quoted(c) for c in numbered.columns], F.coalesce(is_set, F.lit(False)).alias(listed))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without their repeated lines, with all their columns, and n_lines and n_dropped.

    A line is dropped if an earlier line (by document id, then place) has the same words, or, with
    ``MIN_NEAR_WORDS`` words or more, differs from it by one word (edit distance 1 in words, A-Z and other
    letters lower-cased). Lines without words stay. Null texts stay null and have no lines. Every row is a
    document of its own: rows that share an id, or have none, come in the order in which they are read,
    and a row that repeats an earlier one loses its lines. A null id counts as the smallest. Ids are
    whole numbers. Clashing names of the two counts get a longer name.

    Halves of lines are matched first, which loses no pair: only lines that share a half with a different
    line have their deletion neighbourhood built. ``docs`` is read four times; stage it if its plan is dear.
    """
    work = Workspace(docs.sparkSession, "lines")
    row = fresh_column(docs, "row")
    numbered, source = _numbered(docs, row, id_col, text_col, work)
    n = F.size("words")
    lines = work.stage(_lines(source).select(
        "place", "row", "line_no", *_line_keys(F.col("words")),
        n.alias("n"), *[key.alias(name) for name, key in _half_keys(F.col("words"), n).items()],
    ))
    contents = [c for c in lines.columns if c not in ("place", "row", "line_no", "k1", "k2")]
    first = work.stage(lines.groupBy("k1", "k2").agg(
        F.min("place").alias("place"), *[F.min(c).alias(c) for c in contents], F.count(F.lit(1)).cast("int").alias("times"),
    ))
    near = _near_lines(first, source, work)
    # Lines that stand there once and are like no earlier one have nothing to be joined for.
    repeated = first.where("times > 1").select("k1", "k2", "place", F.lit(False).alias("near"))
    found = repeated.unionByName(near.withColumn("near", F.lit(True)))
    kept = work.stage(found.groupBy("k1", "k2").agg(F.min("place").alias("first"), F.max("near").alias("near")))
    sieved = _sieved(lines.select("k1", "k2", "place", "row", "line_no"), "k1", kept)
    dropped = sieved.join(kept, ["k1", "k2"]).where("near or place != first")
    drop_row, drops = (fresh_column(numbered, c) for c in ("drop_row", "drops"))
    # As many numbers as the row has lines.
    by_row = work.stage(dropped.groupBy(F.col("row").alias(drop_row)).agg(F.collect_set("line_no").alias(drops)))
    work.drop(lines, first, near, kept)

    if fits_in_every_task(by_row, max_bytes=_REPLICATED_BYTES):
        joined = numbered.join(F.broadcast(by_row), F.col(row) == F.col(drop_row), "left")
    else:
        # Only texts that lose lines, and the few that a bitmap of bounded size takes for them, are moved for the join.
        listed = fresh_column(numbered, "listed")
        marked_rows = _listed(numbered, row, by_row, drop_row, listed)
        moved = marked_rows.where(listed).join(by_row, F.col(row) == F.col(drop_row), "left").drop(listed)
        joined = marked_rows.where(~F.col(listed)).drop(listed).unionByName(moved, allowMissingColumns=True)
    # A column of its own: inside of the function below it would be split again for every line.
    parted = fresh_column(joined, "parted")
    joined, all_lines = joined.withColumn(parted, F.split(F.col(text_col), "\n")), F.col(parted)
    left = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col(drops))
    text = F.when(F.col(drops).isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(left, lambda i: F.get(all_lines, i)), "\n"))
    n_lines, n_dropped = (fresh_column(docs, c) for c in ("n_lines", "n_dropped"))
    return joined.select(
        *[text.alias(c) if c == text_col else quoted(c) for c in docs.columns],
        F.when(F.col(text_col).isNull(), 0).otherwise(F.size(all_lines)).alias(n_lines),
        F.when(F.col(text_col).isNull() | F.col(drops).isNull(), 0).otherwise(F.size(drops)).alias(n_dropped),
    )


def without_repeated_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without their repeated lines, with their columns only.

    A document all of whose lines are repeats is a copy and goes; one that had no words stays.
    """
    cleaned = dedup_lines(docs, id_col=id_col, text_col=text_col)
    n_dropped = cleaned.columns[-1]
    empty = F.length(F.btrim(F.col(text_col), F.lit(BLANKS + "\n"))) == 0
    return cleaned.where(~F.coalesce(empty, F.lit(False)) | (F.col(n_dropped) == 0)).select(*docs.columns)
