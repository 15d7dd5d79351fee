"""Line dedup by content-defined chunks (op 9); DataFrame functions only.

A text is cut at line breaks. A rolling hash (polynomial modulo a prime) over the hashes of two neighbouring lines chooses
where a chunk begins: where it is lowest among its neighbours, so no chunk between two boundaries has fewer than two lines,
and inserted or removed lines move no boundary but those next to them. A line of 50 words or more is a chunk
by itself. Of the chunks that occur more than once in all documents, those of two lines or more, or of one such long
line, are removed everywhere but at their first place (smallest doc_id, then position; null ids last). Chunks without any
visible character stay.

Chunks meet by a 64-bit hash, in narrow rows that are aggregated before the shuffle. Beside that, all chunks are compared byte
by byte (grouped by their text, once per task before the shuffle): should texts of one hash differ, each of them is
decided on its own text. No join brings the places of a chunk that a third of all documents have to one task.

A chunk's first and last lines can depend on the lines around a passage, so chunks alone miss parts of repeated passages. With
`windows`, every run of neighbouring lines that just reaches 50 words, from each line on and back from each line, is compared
over all documents too, by hash and then byte by byte. All lines that a repeated run covers are removed but at its first
place; any repeated passage of 50 words or more is covered by such runs from its first visible line to its last. The query
op9_line_chunks alone goes without them, as `SQL` fixes its result.

A null text stays null, with no chunks. Rows repeated with id and text count once and get the same result; rows with one
id and other texts are other documents, ordered by the hash of their text. Texts are never cut short. Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage

#: Prime and base of the rolling hash; spaces in a line of 50 words.
PRIME, BASE, LONG = 2_147_483_647, 1_000_003, 49
#: What a visible line has.
VISIBLE = r"[^\x20\x09-\x0D]"


def _hash(line: Column) -> Column:
    """The first 28 bits of a line's MD5."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 7), 16, 10).cast("long")


def _long(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) >= LONG


def chunked(docs: DataFrame, text: str) -> DataFrame:
    """Adds `chunks`, an array of (idx, start, n_lines, body), to every row; the rows are otherwise as they were."""
    lines = docs.withColumn("__lines", F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1))
    hashed = lines.withColumn("__marks", F.transform("__lines", lambda x: F.struct(_hash(x).alias("h"), _long(x).alias("long"))))

    def roll(mark: Column, i: Column) -> Column:
        before = F.get("__marks", i - 1)
        return F.when(i > 0, (before["h"] * BASE + mark["h"]) % PRIME).otherwise(-1)

    rolled = hashed.withColumn("__rolls", F.transform("__marks", roll))

    def begins(i: Column) -> Column:
        here, before, after = (F.coalesce(F.get("__rolls", k), F.lit(-1)) for k in (i, i - 1, i + 1))
        long = F.get("__marks", i)["long"] | F.coalesce(F.get("__marks", i - 1)["long"], F.lit(False))
        return (i == 0) | long | ((here < before) & (here <= after))

    starts = rolled.withColumn("__starts", F.filter(F.sequence(F.lit(0), F.size("__lines") - 1), begins))

    def piece(start: Column, k: Column) -> Column:
        n = F.coalesce(F.get("__starts", k + 1), F.size("__lines")) - start
        return F.struct(k.alias("idx"), start.alias("start"), n.alias("n_lines"), F.array_join(F.slice("__lines", start + 1, n), "\n").alias("body"))

    return starts.withColumn("chunks", F.transform("__starts", piece)).drop("__lines", "__marks", "__rolls", "__starts")


def _places(docs: DataFrame) -> DataFrame:
    """One row per chunk that may be removed: its place (doc_id, digest, idx), hash and body.

    explode_outer, as explode would add a filter on the size of the array, and push its whole making below.
    """
    rows = docs.select("doc_id", "digest", F.explode_outer("chunks").alias("c")).select("doc_id", "digest", "c.idx", "c.n_lines", "c.body")
    body = F.col("body")
    rows = rows.filter(((F.col("n_lines") > 1) | _long(body)) & body.rlike(VISIBLE))
    return rows.select("doc_id", "digest", "idx", F.xxhash64("body").alias("chunk"), "body")


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest", "idx")


def removals(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, removed): which chunks to leave out of which texts; `docs` has doc_id, digest, chunks."""
    places = _places(docs)
    narrow = stage(places.drop("body"), "chunk-places")
    repeated = stage(
        narrow.groupBy("chunk")
        .agg(F.min(_place()).alias("first"), F.max(_place()).alias("last"))
        .filter(~F.col("first").eqNullSafe(F.col("last")))
        .select("chunk", "first"),
        "repeated-chunks",
    )
    # byte comparison: texts grouped by all their bytes, combined before the shuffle
    bodies = places.select("chunk", "body").distinct()
    mixed = stage(bodies.groupBy("chunk").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("chunk"), "mixed-chunks")
    plain = narrow.join(repeated.join(mixed, "chunk", "left_anti"), "chunk").filter(~F.col("first").eqNullSafe(_place()))
    among = places.join(mixed, "chunk", "left_semi")
    firsts = among.groupBy("chunk", "body").agg(F.min(_place()).alias("first"))
    apart = among.join(firsts, ["chunk", "body"]).filter(~F.col("first").eqNullSafe(_place()))
    both = plain.select("doc_id", "digest", "idx").union(apart.select("doc_id", "digest", "idx"))
    return both.groupBy("doc_id", "digest").agg(F.collect_set("idx").alias("removed"))


def windowed(docs: DataFrame, text: str) -> DataFrame:
    """Adds `windows`, an array of (start, end, window), the lines and the hash of each run that just reaches 50 words.

    Runs begin and end with visible lines, so each has at most 50 of them.
    """
    lines = docs.withColumn("__lines", F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1))
    marks = F.transform("__lines", lambda x, i: F.struct(i.alias("at"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("words"), x.rlike(VISIBLE).alias("seen")))
    marked = lines.withColumn("__hashes", F.transform("__lines", lambda x: F.xxhash64(x))).withColumn("__seen", F.filter(marks, lambda m: m["seen"]))

    def reach(some: Column) -> Column:
        """The line where the words of `some` reach the limit, or null."""
        nothing = F.struct(F.lit(0).alias("words"), F.lit(-1).alias("at"))
        more = lambda sofar, m: F.when(sofar["words"] > LONG, sofar).otherwise(F.struct((sofar["words"] + m["words"]).alias("words"), m["at"].alias("at")))
        return F.aggregate(some, nothing, more, lambda sofar: F.when(sofar["words"] > LONG, sofar["at"]))

    # start and end in one number, as arrays of numbers are made distinct by hash
    both = lambda start, end: F.shiftleft(start.cast("long"), 32) + end
    onward = F.transform("__seen", lambda m, k: both(m["at"], reach(F.slice("__seen", k + 1, F.lit(LONG + 1)))))
    first = lambda k: F.greatest(k - LONG, F.lit(0))
    back = F.transform("__seen", lambda m, k: both(reach(F.reverse(F.slice("__seen", first(k) + 1, k - first(k) + 1))), m["at"]))
    runs = marked.withColumn("__runs", F.array_union(F.filter(onward, lambda x: x.isNotNull()), F.filter(back, lambda x: x.isNotNull())))

    def run(x: Column) -> Column:
        start, end = F.shiftright(x, 32).cast("int"), x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
        return F.struct(start.alias("start"), end.alias("end"), F.xxhash64(F.slice("__hashes", start + 1, end - start + 1)).alias("window"))

    return runs.withColumn("windows", F.transform("__runs", run)).drop("__lines", "__hashes", "__seen", "__runs")


def covered_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, from, to): lines to leave out of texts, as a repeated run covers them; `docs` has doc_id, digest, text."""
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest", "start", "end")
    rows = windowed(docs, "text").select("doc_id", "digest", F.explode_outer("windows").alias("w")).select("doc_id", "digest", "w.*")
    narrow = stage(rows.filter("window IS NOT NULL"), "window-places")
    repeated = stage(
        narrow.groupBy("window")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter(~F.col("first").eqNullSafe(F.col("last")))
        .select("window", "first"),
        "repeated-windows",
    )
    # byte comparison of the repeated runs only: each text is met by its own
    hits = stage(narrow.join(repeated, "window").select("doc_id", "digest", "start", "end", "window", "first"), "window-hits")
    own = hits.groupBy(F.col("doc_id").alias("its_id"), F.col("digest").alias("its_digest")).agg(F.collect_set(F.struct("start", "end", "window")).alias("own"))
    met = F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("digest") == F.col("its_digest"))
    lines = docs.join(own.hint("merge"), met).withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    # cut out before they are dealt out, so that no row of them carries the whole text
    body = lambda w: F.array_join(F.slice("lines", w["start"] + 1, w["end"] - w["start"] + 1), "\n")
    cut = F.transform("own", lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"), w["window"].alias("window"), body(w).alias("body")))
    bodies = lines.select("doc_id", "digest", F.explode_outer(cut).alias("w")).select("doc_id", "digest", "w.*")
    differ = bodies.select("window", "body").distinct().groupBy("window").agg(F.count(F.lit(1)).alias("n"))
    mixed = stage(differ.filter("n > 1").select("window"), "mixed-windows")
    among = bodies.join(mixed, "window", "left_semi")
    firsts = among.groupBy("window", "body").agg(F.min(place).alias("first"))
    apart = among.join(firsts, ["window", "body"]).select("doc_id", "digest", "start", "end", "first")
    plain = hits.join(mixed, "window", "left_anti").select("doc_id", "digest", "start", "end", "first")
    both = plain.union(apart).filter(~F.col("first").eqNullSafe(place))
    # a run that overlaps its own first place leaves that whole
    same = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.digest") == F.col("digest"))
    begin = F.when(same, F.greatest("start", F.col("first.end") + 1)).otherwise(F.col("start"))
    return both.select("doc_id", "digest", begin.alias("from"), F.col("end").alias("to")).filter(F.col("from") <= F.col("to"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", windows: bool = True) -> DataFrame:
    """(row, kept_text, n_chunks, n_removed): every row of `docs` as a struct, so that no column name can clash.

    With `windows`, n_removed also counts the chunks that lost some lines only.
    """
    digest = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), digest.alias("digest"), F.col(text_col).alias("text"))
    gone = removals(chunked(rows.drop("row"), "text").select("doc_id", "digest", "chunks"))
    if windows:
        covered = covered_lines(rows.drop("row")).groupBy("doc_id", "digest").agg(F.collect_set(F.struct("from", "to")).alias("covered"))
        none = F.array().cast("array<int>")
        gone = gone.withColumn("covered", F.lit(None).cast("array<struct<from:int,to:int>>"))
        gone = gone.unionByName(covered.withColumn("removed", F.lit(None).cast("array<int>")))
        gone = gone.groupBy("doc_id", "digest").agg(F.coalesce(F.max("removed"), none).alias("removed"), F.max("covered").alias("covered"))
    gone = stage(gone, "removed-chunks")
    gone = gone.withColumnsRenamed({"doc_id": "its_id", "digest": "its_digest"})
    met = F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("digest") == F.col("its_digest"))
    both = chunked(rows.join(gone.hint("merge"), met, "left").drop("doc_id", "digest", "its_id", "its_digest"), "text")
    stays = F.filter("chunks", lambda c: ~F.array_contains("removed", c["idx"]))
    kept, n_removed = F.array_join(F.transform(stays, lambda c: c["body"]), "\n"), F.size("removed")
    if windows:
        lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
        left = F.flatten(F.transform(stays, lambda c: F.sequence(c["start"], c["start"] + c["n_lines"] - 1)))
        out = F.flatten(F.transform("covered", lambda x: F.sequence(x["from"], x["to"])))
        both = both.withColumn("lines", lines).withColumn("left", F.array_except(left, out))
        chunk_of = F.flatten(F.transform("chunks", lambda c: F.array_repeat(c["idx"], c["n_lines"])))
        both = both.withColumn("chunk_of", chunk_of).withColumn("out", F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "left"))
        n_removed = F.when(F.col("covered").isNull(), n_removed).otherwise(F.size(F.array_distinct(F.transform("out", lambda i: F.get("chunk_of", i)))))
        kept = F.when(F.col("covered").isNull(), kept).otherwise(F.array_join(F.transform("left", lambda i: F.get("lines", i)), "\n"))
    kept = F.when(F.col("removed").isNull(), F.col("text")).otherwise(kept)
    return both.select(
        "row",
        kept.alias("kept_text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("chunks")).alias("n_chunks"),
        F.when(F.col("removed").isNull(), 0).otherwise(n_removed).alias("n_removed"),
    )


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", windows: bool = True) -> DataFrame:
    """Adds `kept_text`, `n_chunks` and `n_removed` to every row of `docs`, in place of columns of these names."""
    found = without_repeats(docs, id_col, text_col, windows)
    added = ["kept_text", "n_chunks", "n_removed"]
    return found.select(*(F.col(f"row.`{c}`") for c in docs.columns if c not in added), *added)


#: The same result in SQL, grouping whole chunks by their text.
SQL = rf"""
WITH docs AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
    SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs
),
marks AS (
    SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h, length(line) - length(replace(line, ' ', '')) >= {LONG} AS long FROM lines
),
rolls AS (
    SELECT *, CASE WHEN pos = 1 THEN -1 ELSE (lag(h) OVER w * {BASE} + h) % {PRIME} END AS roll, coalesce(lag(long) OVER w, false) AS after_long
    FROM marks WINDOW w AS (PARTITION BY doc_id, text ORDER BY pos)
),
cuts AS (
    SELECT *, CASE WHEN pos = 1 OR long OR after_long OR (roll < lag(roll, 1, -1) OVER w AND roll <= lead(roll, 1, -1) OVER w) THEN 1 ELSE 0 END AS cut
    FROM rolls WINDOW w AS (PARTITION BY doc_id, text ORDER BY pos)
),
placed AS (SELECT *, sum(cut) OVER (PARTITION BY doc_id, text ORDER BY pos) AS idx FROM cuts),
chunks AS (
    SELECT doc_id, text, idx, string_agg(line, chr(10) ORDER BY pos) AS body,
           (count(*) > 1 OR bool_or(long)) AND bool_or(regexp_matches(line, '[^\x20\x09-\x0D]')) AS able
    FROM placed GROUP BY doc_id, text, idx
),
ranked AS (
    SELECT *, able AND row_number() OVER (PARTITION BY able, body ORDER BY doc_id, idx) > 1 AS gone FROM chunks
)
SELECT doc_id, CAST(count(*) AS INTEGER) AS n_chunks, CAST(count(*) FILTER (gone) AS INTEGER) AS n_removed,
       CAST(length(coalesce(string_agg(body, chr(10) ORDER BY idx) FILTER (NOT gone), '')) AS INTEGER) AS n_chars_kept,
       md5(coalesce(string_agg(body, chr(10) ORDER BY idx) FILTER (NOT gone), '')) AS kept_md5
FROM ranked GROUP BY doc_id, text
"""
