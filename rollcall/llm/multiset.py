r"""Homomorphic multiset hash of a document's paragraphs (op 11), in DataFrame functions only.

A paragraph is a line of the text, empty ones included. It is hashed to a wide vector:

* 8 lanes modulo 2**32, the words of its SHA-256;
* 128 lanes modulo 2**16: its tiles (up to four words from its start on, cut anew after a sentence mark; the empty tile if it
  has none) each add 1 or -1 to a lane, by a bit of the tile's MD5.

A document's fingerprint is the sum of its paragraphs' vectors, lane by lane, as 64 + 512 hex digits. So it does not depend on
the paragraphs' order, a paragraph is put in or taken out by adding or subtracting its vector (`combine`), and texts with the
same paragraphs have the same fingerprint; else the first 8 lanes differ, but for a collision of sums of SHA-256.

The 128 lanes are a random projection of the count of every tile: the squared length of a difference of fingerprints
estimates the squared difference of the counts. `likeness` is 1 - |a - b|**2 / (|a|**2 + |b|**2), not below 0, and 1 for equal
fingerprints: about the share of tiles that two texts of one length have in common (standard error about 0.09). Lanes stay
small numbers to about 10**7 tiles of one text; above that the likeness of texts that differ a lot loses its meaning.

`next_documents` puts beside every text the one after it in the order of id, hash of the text and place in the table, and
after the last the first. Rows with one id and text are documents of their own. The order is cut into blocks at keys that are
found by a range partition of the keys alone. The first row of each block also goes to the block before it, so texts are shuffled
once, and equal ids are cut as well as others. Null ids come first. A null text is empty. Texts are never cut short. Other
columns are left out, so none can clash. A table of one row: the row follows itself. Empty table: no rows.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .inputs import texts

EXACT, NEAR = 8, 128
#: Up to four words between sentence marks.
TILE = r"[^ .!?]+(?: +[^ .!?]+){0,3}"
#: Two lanes of 32 bits in one number.
_PAIR = 0x0000000100000001


def _key() -> list[Column]:
    return [F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64("text").alias("th"), F.monotonically_increasing_id().alias("place")]


def next_documents(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """block, nth, doc_id, text, next_text, ghost: a ghost is the row that follows a block, and is in the block after it too.

    `docs` (doc_id, text) is read twice and must come in the same order both times, as a written table does.
    """
    blocks = blocks or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select("doc_id", "text", F.struct(*_key()).alias("key"))
    dealt = keyed.select("key").repartitionByRange(blocks, "key").groupBy(F.spark_partition_id().alias("of")).agg(F.min("key").alias("key"))
    # the first key of every block: at most `blocks` rows, a parameter; as one constant of the plan
    firsts = sorted(r["key"] for r in dealt.collect())
    kind = "array<struct<known boolean, id bigint, th bigint, place bigint>>"
    cuts = F.from_json(F.lit(json.dumps([r.asDict() for r in firsts])), kind)

    def half(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        after = F.struct((middle + 1).alias("low"), at["high"].alias("high"))
        not_after = F.struct(at["low"].alias("low"), middle.alias("high"))
        return F.when(at["low"] >= at["high"], at).when(F.element_at(cuts, middle + 1) <= F.col("key"), after).otherwise(not_after)

    # how many cuts are at or before the key, by halves
    steps = F.sequence(F.lit(0), F.lit(blocks.bit_length()))
    cut_below = F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high")), half)["low"]
    found = keyed.select("doc_id", "text", "key", F.greatest(cut_below - 1, F.lit(0)).alias("own"))
    found = found.select("*", F.size(cuts).alias("n"), F.element_at(cuts, F.col("own") + 1).alias("cut"))
    here = F.struct(F.col("own").alias("block"), F.lit(False).alias("ghost"))
    before = F.struct(F.pmod(F.col("own") - 1, F.col("n")).alias("block"), F.lit(True).alias("ghost"))
    sent = found.withColumn("to", F.explode(F.when(F.col("key") == F.col("cut"), F.array(here, before)).otherwise(F.array(here))))
    order = W.partitionBy("block").orderBy("ghost", "key")
    rows = sent.select("doc_id", "text", "key", F.col("to.block").alias("block"), F.col("to.ghost").alias("ghost"))
    return rows.select("block", "ghost", "doc_id", "text", F.row_number().over(order).alias("nth"), F.lead("text").over(order).alias("next_text"))


def edited(text: Column, following: Column) -> Column:
    """The text with its last half in place of the first as many characters of the text that follows."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def paragraphs(rows: DataFrame, text: str, *keep: str) -> DataFrame:
    """The columns of `keep` and a row for every tile of every paragraph: `sha` at a paragraph's first tile, and `tile`."""
    lines = rows.select(*keep, F.explode(F.split(F.col(text), "\n", -1)).alias("line"))
    hashed = lines.select(*keep, F.sha2(F.col("line").cast("binary"), 256).alias("sha"), F.regexp_extract_all("line", F.lit(TILE), F.lit(0)).alias("tiles"))
    tiles = hashed.select(*keep, "sha", F.posexplode_outer("tiles").alias("at", "tile"))
    return tiles.select(*keep, F.when(F.coalesce("at", F.lit(0)) == 0, F.col("sha")).alias("sha"), F.md5(F.coalesce("tile", F.lit("")).cast("binary")).alias("tile"))


def _word(hexes: Column, k: int, digits: int = 8) -> Column:
    return F.conv(F.substring(hexes, digits * k + 1, digits), 16, -10).cast("long")


def lanes(tiles: DataFrame, *by: str) -> DataFrame:
    """`by` and `lanes`, an array of the 8 and the 128 lanes, from the rows of `paragraphs`."""
    wide = tiles.select(*by, *(_word(F.col("sha"), k).alias(f"e{k}") for k in range(EXACT)), *(_word(F.col("tile"), k, 16).alias(f"w{k}") for k in range(2)))
    sums = [F.sum(f"e{k}").alias(f"e{k}") for k in range(EXACT)] + [F.count(F.lit(1)).alias("n")]
    sums += [F.sum(F.shiftrightunsigned(f"w{w}", i).bitwiseAND(F.lit(_PAIR))).alias(f"w{w}_{i}") for w in range(2) for i in range(32)]
    summed = wide.groupBy(*by).agg(*sums)
    exact = [F.col(f"e{k}").bitwiseAND(F.lit(0xFFFFFFFF)) for k in range(EXACT)]
    low, high = (lambda c: c.bitwiseAND(F.lit(0xFFFFFFFF))), (lambda c: F.shiftrightunsigned(c, 32))
    near = [(2 * f(F.col(f"w{w}_{i}")) - F.col("n")).bitwiseAND(F.lit(0xFFFF)) for w in range(2) for f in (low, high) for i in range(32)]
    return summed.select(*by, F.array(*exact, *near).alias("lanes"))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The lanes of both documents' paragraphs together, or (sign -1) of the first without those of the second."""

    def summed(start: int, n: int, mask: int) -> Column:
        return F.zip_with(F.slice(a, start, n), F.slice(b, start, n), lambda x, y: (x + sign * y).bitwiseAND(F.lit(mask)))

    return F.concat(summed(1, EXACT, 0xFFFFFFFF), summed(EXACT + 1, NEAR, 0xFFFF))


def fingerprint(lane: Column) -> Column:
    """The lanes as text: 8 hex digits for each of the first 8, 4 for each other."""
    return F.lower(F.array_join(F.transform(lane, lambda x, i: F.lpad(F.hex(x), F.when(i < EXACT, F.lit(8)).otherwise(F.lit(4)), F.lit("0"))), ""))


def _centred(x: Column) -> Column:
    return F.when(x >= 1 << 15, x - (1 << 16)).otherwise(x)


def _square(lane: Column) -> Column:
    return F.aggregate(F.slice(lane, EXACT + 1, NEAR), F.lit(0).cast("long"), lambda s, x: s + _centred(x) * _centred(x))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1, from the lanes of two documents."""
    both = _square(a) + _square(b)
    apart = 1 - _square(combine(a, b, -1)) / F.nullif(both, F.lit(0))
    return F.when(F.slice(a, 1, EXACT) == F.slice(b, 1, EXACT), F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.coalesce(apart, F.lit(0.0))))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and `lanes` of every row; rows with one id and text give one row."""
    rows = texts(docs, id_col, text_col).distinct()
    rows = rows.select("doc_id", F.xxhash64("text").alias("th"), F.sha2(F.col("text").cast("binary"), 256).alias("sha_of"), "text")
    return lanes(paragraphs(rows, "text", "doc_id", "th", "sha_of"), "doc_id", "th", "sha_of").select("doc_id", "lanes")


def edited_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """Every document's fingerprint beside those of its edited text and of the next document."""
    rows = next_documents(texts(docs, id_col, text_col), blocks)
    place = ["block", "nth"]
    change = F.when(F.col("ghost"), F.lit("")).otherwise(edited(F.col("text"), F.col("next_text")))
    both = rows.select(*place, "ghost", "doc_id", F.length("text").alias("n_chars"), "text", change.alias("change"))
    told = ["ghost", "doc_id", "n_chars", "edited_sha256"]
    both = both.withColumn("edited_sha256", F.sha2(F.col("change").cast("binary"), 256))
    # a ghost has no edited text
    sides = F.when(F.col("ghost"), F.array(_side(0, "text"))).otherwise(F.array(_side(0, "text"), _side(1, "change")))
    each = both.select(*place, *told, F.explode(sides).alias("side")).select(*place, *told, F.col("side.which").alias("which"), F.col("side.body").alias("body"))
    keys = [*place, "which", *told]
    summed = lanes(paragraphs(each, "body", *keys), *keys)
    mine = summed.groupBy(*place, *told).agg(
        F.max(F.when(F.col("which") == 0, F.col("lanes"))).alias("own"), F.max(F.when(F.col("which") == 1, F.col("lanes"))).alias("changed")
    )
    following = F.lead("own").over(W.partitionBy("block").orderBy("nth"))
    found = mine.withColumn("following", following).filter(~F.col("ghost"))
    return found.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )


def _side(which: int, body: str) -> Column:
    return F.struct(F.lit(which).alias("which"), F.col(body).alias("body"))


def _sql() -> str:
    exact = ", ".join(f"sum(('0x' || substr(sha, {8 * k + 1}, 8))::BIGINT)::BIGINT & 4294967295" for k in range(EXACT))
    bits = [f"(2 * sum((q{q} >> {i}) & 1) - count(*))::BIGINT & 65535" for q in (1, 0, 3, 2) for i in range(32)]
    words = ", ".join(f"('0x' || substr(tile, {8 * q + 1}, 8))::BIGINT AS q{q}" for q in range(4))

    def square(a: str, b: str | None = None) -> str:
        lane = "((x[1] - x[2] + 98304) & 65535) - 32768" if b else "((x + 32768) & 65535) - 32768"
        rows = f"list_zip({a}, {b})" if b else a
        return f"list_sum(list_transform({rows}, lambda x: ({lane}) * ({lane})))"

    def near(a: str, b: str) -> str:
        apart = f"1 - {square(f'{a}.near', f'{b}.near')}::BIGINT / nullif({square(f'{a}.near')}::BIGINT + {square(f'{b}.near')}::BIGINT, 0)"
        return f"CASE WHEN {a}.exact = {b}.exact THEN 1.0::DOUBLE ELSE greatest(0.0::DOUBLE, coalesce({apart}, 0.0::DOUBLE)) END"

    def hexes(a: str) -> str:
        return f"array_to_string(list_transform({a}.exact, lambda x: printf('%08x', x)), '') || array_to_string(list_transform({a}.near, lambda x: printf('%04x', x)), '')"

    return f"""
WITH docs AS (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST) AS row, doc_id, coalesce(text, '') AS text FROM documents),
beside AS (
    SELECT *, coalesce(lead(text) OVER (ORDER BY row), first_value(text) OVER (ORDER BY row)) AS next_text,
           coalesce(lead(row) OVER (ORDER BY row), 1) AS next_row FROM docs
),
changed AS (
    SELECT *, substr(text, 1, length(text) - length(text) // 2) || substr(next_text, 1, length(text) // 2) AS change FROM beside
),
sides AS (SELECT row, 0 AS which, text AS body FROM changed UNION ALL SELECT row, 1, change FROM changed),
lines AS (SELECT row, which, unnest(string_split(body, chr(10))) AS line FROM sides),
cut AS (SELECT row, which, sha256(line) AS sha, regexp_extract_all(line, '{TILE}') AS tiles FROM lines),
tiled AS (
    SELECT row, which, CASE WHEN nth = 1 THEN sha END AS sha, md5(tile) AS tile
    FROM (SELECT row, which, sha, unnest(CASE WHEN len(tiles) = 0 THEN [''] ELSE tiles END) AS tile,
                 unnest(range(1, greatest(len(tiles), 1) + 1)) AS nth FROM cut)
),
wide AS (SELECT row, which, sha, {words} FROM tiled),
lanes AS (SELECT row, which, [{exact}] AS exact, [{", ".join(bits)}] AS near FROM wide GROUP BY row, which)
SELECT d.doc_id, length(d.text)::BIGINT AS n_chars, sha256(d.change) AS edited_sha256, {hexes("a")} AS fingerprint, {hexes("b")} AS edited_fingerprint,
       {near("a", "b")} AS near_edited, {near("a", "c")} AS near_next
FROM changed d JOIN lanes a ON a.row = d.row AND a.which = 0 JOIN lanes b ON b.row = d.row AND b.which = 1
JOIN lanes c ON c.row = d.next_row AND c.which = 0
"""


#: The same result in SQL, where ids are unique.
SQL = _sql()
