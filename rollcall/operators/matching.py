"""Joining two sources by place: exact key first, then a conservative fuzzy fallback."""

from __future__ import annotations

from functools import reduce
from string import ascii_uppercase

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import lookups, similarity, text
from ..functions.values import ratio
from ..session import stage
from .dedupe import keep_best

MIN_RATIO = 0.88
MIN_MARGIN = 0.04
_SLACK = 1e-9


def conform_fund_state(state: Column) -> Column:
    """The conformed state name of the funds source, matched on trimmed upper case."""
    table = F.create_map(*[F.lit(p) for pair in lookups.FUND_STATE_ALIASES.items() for p in pair])
    return F.coalesce(F.try_element_at(table, F.upper(F.trim(state))), state)


def with_place_key(df: DataFrame, state: str = "state", seat: str = "constituency") -> DataFrame:
    """Block (state letters) and key (seat letters)."""
    return df.withColumns(
        {"block": text.key_part(F.col(state)), "key": text.key_part(F.col(seat))}
    )


def seat_holders(df: DataFrame) -> DataFrame:
    """One winner per place key in the latest year; the highest candidate id on a clash."""
    latest = df.agg(F.max("election_year").alias("latest"))
    winners = (
        df.filter("is_winner")
        .join(F.broadcast(latest), F.col("election_year") == F.col("latest"))
        .drop("latest")
    )
    order = [F.col("candidate_id").desc_nulls_last(), F.col("name").asc_nulls_last()]
    return keep_best(with_place_key(winners), ["block", "key"], order)


def norm_key_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on the normalised place key; `right` has one row per key. Adds `_matched`."""
    return left.join(right.withColumn("_matched", F.lit(True)), ["block", "key"], "left")


def unmatched_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right, ["block", "key"], "left_anti")


def _edits(metric: str, floor: float, a: Column, b: Column) -> Column:
    """Most single-letter edits two keys of lengths `a` and `b` may differ by at ratio >= floor.

    Matched letters are a common subsequence, so a Ratcliff ratio r leaves at most
    (1 - r)(a + b) letters to insert or delete.
    """
    room = (a + b) if metric == "ratcliff" else F.greatest(a, b)
    return F.floor(room * (1 - floor) + _SLACK).cast("int")


def _lengths_in_reach(metric: str, floor: float, length: Column) -> Column:
    """Lengths the other key may have."""
    share = floor / (2 - floor) if metric == "ratcliff" else floor
    low = F.ceil(length * share - _SLACK).cast("int")
    high = F.floor(length / share + _SLACK).cast("int")
    return F.sequence(F.greatest(low, F.lit(1)), high)


def _piece_bounds(length: Column, pieces: Column, i: Column) -> tuple[Column, Column]:
    """Start (1-based) and length of piece `i` when a key is cut into near-equal pieces."""
    start = F.floor(length * i / pieces).cast("int")
    end = F.floor(length * (i + 1) / pieces).cast("int")
    return start + 1, end - start


def _letters_shared(a: Column, b: Column) -> Column:
    """Twice the letters two keys share, whatever their order, over all letters; no Ratcliff ratio is higher."""

    def count(text: Column, letter: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(letter), F.lit("")))

    shared = reduce(lambda x, y: x + y, [F.least(count(a, c), count(b, c)) for c in ascii_uppercase])
    return 2 * shared / (F.length(a) + F.length(b))


def candidate_pairs(left: DataFrame, right: DataFrame, floor: float, metric: str) -> DataFrame:
    """Distinct pairs (block, lkey, rkey) that can reach a ratio of `floor`; none is missed.

    Two keys within k edits share at least one of any k + 1 pieces of the right key. Letters added
    less letters dropped is the difference in length, which bounds how far a shared piece can have
    moved. So right keys are cut into pieces, left keys into the substrings that could be
    one, and the two are joined on block, both lengths, piece number and piece text: the pairs
    formed are those that share a piece, not all pairs of a block. A bounded edit distance then
    drops most of the rest before anything is scored. The join is always shuffled: pieces are many
    times larger than the keys they are cut from, which a size estimate does not see.
    """

    def with_pieces(keys: DataFrame, mine: str, other: str, others: DataFrame) -> DataFrame:
        reach = _lengths_in_reach(metric, floor, F.col(mine))
        first, size = _piece_bounds(F.col("rlen"), F.col("k") + 1, F.col("i"))
        present = others.select("block", other).distinct()  # only lengths that the block has
        return (
            keys.filter(F.col(mine) > 0)
            .withColumn(other, F.explode(reach))
            .join(present, ["block", other], "left_semi")
            .withColumn("k", _edits(metric, floor, F.col("llen"), F.col("rlen")))
            .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k"))))
            .withColumns({"first": first, "size": size})
        )

    lefts = left.select("block", F.col("key").alias("lkey")).withColumn("llen", F.length("lkey"))
    rights = right.select("block", F.col("key").alias("rkey")).withColumn("rlen", F.length("rkey"))
    pieces = with_pieces(rights, "rlen", "llen", lefts).select(
        "block", "rkey", "rlen", "llen", "i", F.substr("rkey", F.col("first"), F.col("size")).alias("piece")
    )
    longer = F.col("llen") - F.col("rlen")
    back = F.floor((F.col("k") - longer) / 2).cast("int")
    ahead = F.floor((F.col("k") + longer) / 2).cast("int")
    low = F.greatest(F.col("first") - back, F.lit(1))
    high = F.least(F.col("first") + ahead, F.col("llen") - F.col("size") + 1)
    places = F.transform(
        F.sequence("low", "high"), lambda at: F.substr(F.col("lkey"), at, F.col("size"))
    )
    probes = (
        with_pieces(lefts, "llen", "rlen", rights)
        .withColumns({"low": low, "high": high})
        .filter("low <= high")
        .select("block", "lkey", "rlen", "llen", "i", "k", F.explode(F.array_distinct(places)).alias("piece"))
    )
    return (
        probes.join(pieces.hint("merge"), ["block", "llen", "rlen", "i", "piece"])
        .select("block", "lkey", "rkey", "k")
        .distinct()
        .filter(F.expr("levenshtein(lkey, rkey, k) >= 0"))
        .filter(_letters_shared(F.col("lkey"), F.col("rkey")) >= floor - _SLACK if metric == "ratcliff" else F.lit(True))
        .select("block", "lkey", "rkey")
    )


def _tokens(keys: DataFrame, name: str) -> DataFrame:
    """block, key and one row per letter: the letter and how often it has come so far, so that a key is a set."""
    letters = F.filter(F.split("key", ""), lambda c: c != "")
    numbered = F.transform("_letters", lambda c, i: F.concat(c, F.size(F.filter(F.slice("_letters", 1, i + 1), lambda x: x == c)).cast("string")))
    return keys.withColumn("_letters", letters).select("block", F.col("key").alias(name), F.explode(numbered).alias("token"))


def _needed(metric: str, floor: float, a: Column, b: Column) -> Column:
    """Letters that keys of lengths `a` and `b` must share, whatever their order, at ratio >= floor."""
    room = (a + b) / 2 if metric == "ratcliff" else F.greatest(a, b)
    return F.greatest(F.ceil(room * floor - _SLACK), F.lit(1)).cast("int")


def pairs_by_letters(left: DataFrame, right: DataFrame, floor: float, metric: str) -> DataFrame:
    """Distinct pairs (block, lkey, rkey) that can reach any `floor` above 0; none is missed.

    A key is the set of its numbered letters, in the order of their frequency in the block, rarest first. Two sets of a and b
    letters that share o of them share one among the first a - o + 1 of one and the first b - o + 1 of the other. Those are
    indexed by block and letter, joined, and held to the lengths' own bound; then all letters of a pair are compared.
    """
    sides = {"lkey": _tokens(left, "lkey"), "rkey": _tokens(right, "rkey")}
    seen = sides["lkey"].select("block", "token").union(sides["rkey"].select("block", "token"))
    often = stage(seen.groupBy("block", "token").agg(F.count(F.lit(1)).alias("often")), "letters")

    def index(name: str, length: str, at: str) -> DataFrame:
        ranked = F.sort_array(F.collect_list(F.struct("often", "token")))  # one key's letters
        keys = sides[name].join(often, ["block", "token"]).groupBy("block", name).agg(ranked.alias("_tokens"))
        size = F.size("_tokens")
        shortest = F.ceil(size * (floor / (2 - floor) if metric == "ratcliff" else floor) - _SLACK).cast("int")
        # the least that any partner in reach can share: one of the shortest length
        first = size - _needed(metric, floor, size, F.greatest(shortest, F.lit(1))) + 1
        cut = keys.select("block", name, size.alias(length), F.posexplode(F.slice("_tokens", 1, first)).alias(at, "_token"))
        return cut.select("block", name, length, at, F.col("_token.token").alias("token"))

    both = index("lkey", "llen", "lat").join(index("rkey", "rlen", "rat").hint("merge"), ["block", "token"])
    share = _needed(metric, floor, F.col("llen"), F.col("rlen"))
    near = both.filter((share <= F.least("llen", "rlen")) & (F.col("lat") <= F.col("llen") - share) & (F.col("rat") <= F.col("rlen") - share))
    pairs = near.select("block", "lkey", "rkey").distinct()
    letters = F.col("lkey"), F.col("rkey")
    all_shared = _letters_shared(*letters) * (F.length("lkey") + F.length("rkey")) / 2
    return pairs.filter(all_shared >= _needed(metric, floor, F.length("lkey"), F.length("rkey")) - _SLACK)


def fuzzy_join(
    left: DataFrame,
    right: DataFrame,
    min_ratio: float = MIN_RATIO,
    min_margin: float = MIN_MARGIN,
    metric: str = "ratcliff",
) -> DataFrame:
    """Best right key per unmatched left key inside a block: (block, key, matched_key, similarity).

    A match must reach `min_ratio` and lead the runner-up by `min_margin`. The runner-up may be
    below `min_ratio`, so candidates are generated down to `min_ratio - min_margin`. Keys are made
    distinct first: copies of a key cost nothing more. Nothing is capped.

    Above 2/3, keys share a piece, which is looked up; below that they need only share letters, and the rarest of those
    are looked up. At or below 0 every pair would do, which is refused.
    """
    floor = min_ratio - min_margin
    if not 0 < floor <= 1:
        raise ValueError("min_ratio - min_margin must be above 0 and at most 1")
    right_keys = right.select("block", "key").distinct()
    left_keys = left.select("block", "key").distinct().join(right_keys, ["block", "key"], "left_anti")
    pairs = (candidate_pairs if floor > 2 / 3 else pairs_by_letters)(left_keys, right_keys, floor, metric)
    scored = pairs.withColumn("score", similarity.RATIOS[metric](F.col("lkey"), F.col("rkey")))
    by_score = Window.partitionBy("block", "lkey").orderBy(F.col("score").desc(), "rkey")
    two_best = scored.withColumn("place", F.row_number().over(by_score)).filter("place <= 2")
    return (
        two_best.groupBy("block", "lkey")
        .agg(
            F.min_by("rkey", "place").alias("matched_key"),
            F.max("score").alias("best"),
            F.max(F.when(F.col("place") == 2, F.col("score"))).alias("second"),
        )
        .filter(
            (F.col("best") >= min_ratio)
            & (F.col("second").isNull() | (F.col("best") - F.col("second") >= min_margin))
        )
        .select(
            "block",
            F.col("lkey").alias("key"),
            "matched_key",
            F.round("best", 3).alias("similarity"),
        )
    )


HOLDER_COLUMNS = ["party", "party_group", "criminal_cases", "assets", "candidate_id"]


def join_holders(
    funds: DataFrame, holders: DataFrame, metric: str = "ratcliff", **limits: float
) -> DataFrame:
    """Fund rows with the seat holder's attributes, matched exactly or else fuzzily.

    `funds` and `holders` carry block and key; holders are unique by them. Adds `match_kind`
    (exact, fuzzy or null), `similarity`, `winner_name`, `name_similarity` and
    `holder_differs` (null where nothing matched).
    """
    fuzzy = fuzzy_join(funds, holders, metric=metric, **limits)
    right = holders.select(
        F.col("block"),
        F.col("key").alias("_holder_key"),
        F.lit(True).alias("_found"),
        F.col("state").alias("_state"),
        F.col("constituency").alias("_constituency"),
        F.col("name").alias("winner_name"),
        *HOLDER_COLUMNS,
    )
    joined = (
        funds.join(fuzzy, ["block", "key"], "left")
        .withColumn("_holder_key", F.coalesce("matched_key", "key"))
        .join(right, ["block", "_holder_key"], "left")
        .withColumn(
            "match_kind",
            F.when(F.col("matched_key").isNotNull(), "fuzzy").when(F.col("_found"), "exact"),
        )
        .withColumn("fund_seat", F.col("constituency"))
        .withColumns(
            {
                "state": F.coalesce("_state", text.title_case(F.col("state"))),
                "constituency": F.coalesce("_constituency", text.title_case(F.col("constituency"))),
            }
        )
        .drop("_state", "_constituency", "_found", "_holder_key", "matched_key")
    )
    named = similarity.with_name_similarity(joined, "winner_name", "mp_name", metric=metric)
    known = F.col("match_kind").isNotNull()
    return named.withColumns(
        {
            "name_similarity": F.when(known, F.col("name_similarity")),
            "holder_differs": F.when(known, F.col("name_similarity") < lookups.SAME_PERSON),
        }
    )


def holder_changes(joined: DataFrame) -> DataFrame:
    """Seats whose fund holder is not the recorded winner."""
    return joined.filter("holder_differs").select(
        "constituency",
        "state",
        "winner_name",
        F.col("mp_name").alias("current_mp"),
        F.round("name_similarity", 2).alias("name_similarity"),
    )


def fuzzy_matches(joined: DataFrame) -> DataFrame:
    """Every approximate match, for audit."""
    return joined.filter("match_kind = 'fuzzy'").select(
        "state", "fund_seat", F.col("constituency").alias("matched_to"), "similarity"
    )


def match_report(joined: DataFrame, copies_dropped: DataFrame) -> DataFrame:
    """Seats joined, unmatched and matched approximately, rows with money, duplicates dropped
    (out of the one-row `dedupe_report`) and the match rate."""
    seats = joined.select(
        F.lit(1).alias("seats"),
        F.col("match_kind").isNull().cast("int").alias("unmatched"),
        F.coalesce(F.col("match_kind") == "fuzzy", F.lit(False)).cast("int").alias("fuzzy"),
        (F.coalesce(F.col("allocated"), F.lit(0)) != 0).cast("int").alias("with_allocation"),
    )
    both = seats.unionByName(copies_dropped.select("rows_dropped"), allowMissingColumns=True)
    names = ["seats", "unmatched", "fuzzy", "with_allocation", "rows_dropped"]
    counts = both.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    rate = ratio(F.col("seats") - F.col("unmatched"), F.col("seats"), 1, times=100)
    return counts.withColumn("match_rate_pct", rate)
