"""Quality rules by distribution divergence (op 6).

Each text gets a histogram of character classes and one of common words. The references are the mean histograms of each
language over the whole corpus; a text belongs to the language whose common words it has most of (ties: first in the
list), and texts with none are held against every language, the nearest counting. A text fails if it has at least
`min_words` words and the Jensen-Shannon distance (root of the divergence, base 2) of its character classes is over
`max_classes`, or at least `min_common` words and that of its common words is over `max_common`. Shorter texts say too
little about their distribution and pass (minimum-length guards).

Texts are never cut. Null text: no words, so base_failed. Null ids and repeated rows each get a row. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .inputs import map_texts, texts

#: Common words of each language.
COMMON_WORDS = {
    "en": "the and of to a in is that it was for on with as be by are this at from",
    "de": "der die und in den von das zu mit sich für nicht des auf ist dem im ein eine als",
    "fr": "de la et le les des en du un une que pour est qui dans par sur pas avec au",
    "es": "de la que el en las y los se del un no con por para una su es al lo",
}
#: ASCII characters of each class; bytes that begin a longer character are the last class.
CLASSES = {
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": "0123456789",
    "space": " \t\n\v\f\r",
    "sentence": ".,;:!?'\"()-",
    "symbol": "#*$%&|<>@^~_=+/\\[]{}`",
}
SYMBOLS = "#*$%&|<>"
SPACES = [9, 10, 11, 12, 13, 32]
#: Words in a window, and how many times a hundred repeated words may be a text's words.
WINDOW = 8
#: Mean histograms are summed as whole numbers of this part, so that the order of addition does not matter.
UNIT = 1_000_000


def _class_of_byte() -> np.ndarray:
    of = np.full(256, len(CLASSES) + 1)
    for k, members in enumerate(CLASSES.values()):
        of[list(members.encode())] = k
    of[128:192] = -1  # inside a character
    of[192:] = len(CLASSES)
    return of


def repeated_words(codes: np.ndarray, width: int = WINDOW) -> int:
    """Words in windows of `width` words that the text has twice or more. Equal hashes are checked word by word."""
    n = len(codes) - width + 1
    if n < 2:
        return 0
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    hashes = np.zeros(n, np.uint64)
    for k in range(width):
        hashes = hashes * np.uint64(0xD1342543DE82EF95) + mixed[k : k + n]
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    alike = np.zeros(n, bool)
    alike[1:] |= same
    alike[:-1] |= same
    at = np.sort(order[alike])
    windows = codes[at[:, None] + np.arange(width)]
    _, inverse, counts = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
    twice = at[counts[inverse.ravel()] > 1]
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + width, -1)
    return int((np.cumsum(cover) > 0).sum())


def measure(text: str, class_of_byte: np.ndarray, common: dict[bytes, list[int]], n_common: int) -> tuple:
    data = text.encode()
    bytes_seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    classes = np.bincount(class_of_byte + 1, weights=bytes_seen, minlength=len(CLASSES) + 3)[1:].astype(np.int64)
    words = data.split()
    known: dict[bytes, int] = {}
    codes = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    hits = np.zeros(n_common, np.int64)
    if known:
        counts = np.bincount(codes)
        for code, w in enumerate(known):
            if found := common.get(w.strip(b".,;:!?'\"()").lower()):
                hits[found] += counts[code]
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (
        len(words),
        int(bytes_seen[:128].sum() + bytes_seen[192:].sum() - bytes_seen[SPACES].sum()),
        int(bytes_seen[list(SYMBOLS.encode())].sum()),
        len(lines) - len(set(lines)),
        repeated_words(codes),
        classes,
        hits,
    )


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _common_index() -> tuple[dict[bytes, list[int]], int]:
    """The places of each common word among all languages' words, and how many places there are."""
    words = [w for x in COMMON_WORDS.values() for w in x.split(" ")]
    found: dict[bytes, list[int]] = {}
    for k, word in enumerate(words):
        found.setdefault(word.encode(), []).append(k)
    return found, len(words)


def measures(docs: DataFrame) -> DataFrame:
    """The base counts of every (doc_id, text), with `classes` (by class) and `common` (by word of each language)."""
    common, n_common = _common_index()
    class_of_byte = _class_of_byte()

    def run(ids: list, bodies: list[str]) -> dict:
        rows = list(zip(*(measure(t, class_of_byte, common, n_common) for t in bodies), strict=True)) or [[]] * 7
        long_list = pa.list_(pa.int64())
        return (
            {"doc_id": pa.array(ids, pa.int64())}
            | {n: pa.array(rows[k], pa.int64()) for k, n in enumerate(BASE)}
            | {"classes": pa.array(rows[5], long_list), "common": pa.array(rows[6], long_list)}
        )

    schema = "doc_id long, " + ", ".join(f"{n} long" for n in BASE) + ", classes array<long>, common array<long>"
    return map_texts(docs, run, schema)


def _shares(counts: np.ndarray) -> np.ndarray:
    return counts / np.maximum(counts.sum(axis=-1, keepdims=True), 1)


def _histograms(n_words: np.ndarray, classes: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Class shares, common-word shares by language (the last is all other words), and the language (-1: none)."""
    shares, hits, at = [], [], 0
    for words in COMMON_WORDS.values():
        size = len(words.split(" "))
        own = common[:, at : at + size]
        at += size
        hits.append(own.sum(axis=1))
        shares.append(_shares(np.column_stack([own, np.maximum(n_words - own.sum(axis=1), 0)])))
    hits = np.column_stack(hits)
    return _shares(classes), shares, np.where(hits.max(axis=1) > 0, hits.argmax(axis=1), -1)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of p from q, base 2, rounded to 9 places."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        b = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1)
    return np.round(np.sqrt(np.maximum((a + b) / 2, 0)), 9)


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    def table(name: str, width: int) -> np.ndarray:
        return batch.column(name).flatten().to_numpy().reshape(-1, width)

    n_common = sum(len(x.split(" ")) for x in COMMON_WORDS.values())
    return batch.column("n_words").to_numpy(), table("classes", len(CLASSES) + 2), table("common", n_common)


def references(measured: DataFrame) -> list[tuple[np.ndarray, np.ndarray] | None]:
    """The mean class and common-word histograms of each language, None where no text has it.

    Summed by all tasks; what comes to the driver is one row for each language and bin.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, shares, language = _histograms(*_arrays(batch))
            for k in range(len(shares)):
                own = language == k
                both = np.column_stack([classes, shares[k]])[own]
                sums = np.rint(both * UNIT).astype(np.int64).sum(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(sums), k)), pa.array(np.arange(len(sums))), pa.array(sums), pa.array(np.full(len(sums), own.sum()))],
                    names=["language", "bin", "total", "n"],
                )

    sums = measured.filter("n_words > 0").mapInArrow(run, "language long, bin long, total long, n long")
    rows = sums.groupBy("language", "bin").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    found: list[tuple[np.ndarray, np.ndarray] | None] = []
    for k in range(len(COMMON_WORDS)):
        own = sorted((r["bin"], r["total"]) for r in rows if r["language"] == k and r["n"])
        both = np.array([x[1] for x in own], float)
        width = len(CLASSES) + 2
        found.append((_shares(both[:width]), _shares(both[width:])) if len(both) else None)
    return found


class Judge:
    """The rules with their references and limits, for arrays of measures."""

    def __init__(self, refs: list, max_classes: float = 0.3, max_common: float = 0.29, min_words: int = 20, min_common: int = 100):
        self.refs, self.max_classes, self.max_common = refs, max_classes, max_common
        self.min_words, self.min_common = min_words, min_common

    def __call__(self, n_words: np.ndarray, classes: np.ndarray, common: np.ndarray, repeats: np.ndarray) -> tuple[np.ndarray, ...]:
        """base_failed, kept, language (-1: none), class distance, common-word distance."""
        class_shares, shares, language = _histograms(n_words, classes, common)
        by_class = np.full(len(n_words), np.inf)
        by_word = by_class.copy()
        for k, ref in enumerate(self.refs):
            if ref is not None:
                held = (language == k) | (language == -1)
                by_class[held] = np.minimum(by_class[held], js_distance(class_shares[held], ref[0]))
                by_word[held] = np.minimum(by_word[held], js_distance(shares[k][held], ref[1]))
        by_class, by_word = (np.where(np.isfinite(x), x, 0.0) for x in (by_class, by_word))
        failed = (n_words < 20) | (100 * repeats > 30 * n_words)
        far = (n_words >= self.min_words) & (by_class > self.max_classes) | (n_words >= self.min_common) & (by_word > self.max_common)
        return failed, ~failed & ~far, language, by_class, by_word


def judge(measured: DataFrame, **limits) -> DataFrame:
    """Adds base_failed, kept, language, class_distance and common_distance to `measures`."""
    verdicts = Judge(references(measured), **limits)
    names, columns = list(COMMON_WORDS), ["doc_id", *BASE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            failed, kept, language, by_class, by_word = verdicts(*_arrays(batch), batch.column("n_repeat_words").to_numpy())
            named = pa.array([names[k] if k >= 0 else None for k in language], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in columns), *map(pa.array, (failed, kept)), named, *map(pa.array, (by_class, by_word))],
                names=[*columns, "base_failed", "kept", "language", "class_distance", "common_distance"],
            )

    schema = "doc_id long, " + ", ".join(f"{n} long" for n in BASE)
    return measured.mapInArrow(run, schema + ", base_failed boolean, kept boolean, language string, class_distance double, common_distance double")


def kept(docs: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """The rows of `docs` whose text the rules keep, with all columns. The verdict is made anew beside each row, so no text
    is moved for it."""
    measured = stage(measures(docs.select(F.lit(None).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))), "measures")
    verdicts = Judge(references(measured), **limits)
    common, n_common = _common_index()
    class_of_byte = _class_of_byte()

    @F.pandas_udf("boolean")
    def passes(bodies: pd.Series) -> pd.Series:
        rows = [measure(t or "", class_of_byte, common, n_common) for t in bodies]
        if not rows:
            return pd.Series([], dtype=bool)
        n_words, _, _, _, repeats, classes, hits = (np.array(x) for x in zip(*rows, strict=True))
        return pd.Series(verdicts(n_words, classes, hits, repeats)[1])

    return docs.filter(passes(F.col(text_col)))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    return judge(stage(measures(texts(docs, id_col, text_col)), "measures"), **limits)


def _sql() -> str:
    """The base counts and verdicts in SQL, with the limits of `Judge`."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def held(pattern: str) -> str:
        return f"length(regexp_replace(text, {quoted(pattern)}, '', 'g'))"

    def escaped(members: str) -> str:
        return "".join(f"\\x{ord(c):02X}" for c in members)

    limits = Judge([])
    total = "length(text)"
    counts = {k: f"{total} - {held(f'[{escaped(members)}]')}" for k, members in CLASSES.items()}
    counts["beyond"] = f"{total} - {held('[^\\x00-\\x7F]')}"
    known = " + ".join(f"({c})" for c in counts.values())
    classes = ", ".join(f"struct_pack(bin := {quoted(k)}, n := {c})" for k, c in [*counts.items(), ("other", f"{total} - ({known})")])
    common = ", ".join(f"({quoted(lang)}, {k}, {quoted(w)})" for k, (lang, ws) in enumerate(COMMON_WORDS.items()) for w in ws.split(" "))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def distance(mine: str, theirs: str) -> str:
        return f"""SELECT r, lang, sqrt(greatest(sum(
      CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS far
    FROM (SELECT m.r, m.lang, m.bin, m.share AS p, t.share AS q FROM {mine} m JOIN {theirs} t ON t.lang = m.lang AND t.bin = m.bin)
    GROUP BY r, lang"""

    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT r, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM docs),
tokens AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split),
windows AS (
  SELECT r, i, word, CASE WHEN count(*) OVER w = {WINDOW} THEN string_agg(word, ' ') OVER w END AS shingle
  FROM tokens WINDOW w AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)),
twice AS (SELECT r, i, word, shingle IS NOT NULL AND count(*) OVER (PARTITION BY r, shingle) > 1 AS twice FROM windows),
covered AS (
  SELECT r, word, bool_or(twice) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) AS covered FROM twice),
by_word AS (SELECT r, count(*) AS n_words, CAST(sum(length(word)) AS BIGINT) AS word_chars, count(*) FILTER (covered) AS n_repeat_words FROM covered GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
by_line AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
base AS (
  SELECT docs.r, doc_id, text, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         {total} - {held(f'[{escaped(SYMBOLS)}]')} AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM docs LEFT JOIN by_word USING (r) LEFT JOIN by_line USING (r)),
common(lang, nth, word) AS (VALUES {common}),
hits AS (
  SELECT r, lang, nth, c.word AS bin, count(*) AS n FROM tokens t
  JOIN common c ON c.word = translate(trim(t.word, '.,;:!?''"()'), '{upper}', '{lower}') GROUP BY ALL),
by_lang AS (SELECT r, lang, nth, sum(n) AS n FROM hits GROUP BY ALL),
language AS (SELECT r, arg_max(lang, (n, -nth)) AS lang FROM by_lang GROUP BY r),
langs AS (SELECT DISTINCT lang FROM common),
held AS (
  SELECT base.r, langs.lang FROM base CROSS JOIN langs LEFT JOIN language USING (r)
  WHERE n_words > 0 AND (language.lang IS NULL OR language.lang = langs.lang)),
class_counts AS (SELECT r, unnest([{classes}]) AS c FROM base WHERE n_words > 0),
class_shares AS (
  SELECT r, lang, c.bin AS bin, c.n / greatest(sum(c.n) OVER (PARTITION BY r, lang), 1) AS share FROM class_counts JOIN held USING (r)),
word_counts AS (
  SELECT h.r, h.lang, c.word AS bin, coalesce(hits.n, 0) AS n FROM held h JOIN common c ON c.lang = h.lang
  LEFT JOIN hits ON hits.r = h.r AND hits.lang = h.lang AND hits.bin = c.word
  UNION ALL
  SELECT h.r, h.lang, ' ', n_words - coalesce(by_lang.n, 0) FROM held h JOIN base USING (r) LEFT JOIN by_lang ON by_lang.r = h.r AND by_lang.lang = h.lang),
word_shares AS (SELECT r, lang, bin, n / sum(n) OVER (PARTITION BY r, lang) AS share FROM word_counts),
class_sums AS (SELECT lang, bin, sum(CAST(round_even(share * {UNIT}, 0) AS HUGEINT)) AS n FROM class_shares JOIN language USING (r, lang) GROUP BY ALL),
word_sums AS (SELECT lang, bin, sum(CAST(round_even(share * {UNIT}, 0) AS HUGEINT)) AS n FROM word_shares JOIN language USING (r, lang) GROUP BY ALL),
class_refs AS (SELECT lang, bin, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY lang) AS share FROM class_sums),
word_refs AS (SELECT lang, bin, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY lang) AS share FROM word_sums),
class_far AS (SELECT r, round(min(far), 9) AS by_class FROM ({distance('class_shares', 'class_refs')}) GROUP BY r),
word_far AS (SELECT r, round(min(far), 9) AS by_word FROM ({distance('word_shares', 'word_refs')}) GROUP BY r),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         n_words >= {limits.min_words} AND coalesce(by_class, 0) > {limits.max_classes}
         OR n_words >= {limits.min_common} AND coalesce(by_word, 0) > {limits.max_common} AS far
  FROM base LEFT JOIN class_far USING (r) LEFT JOIN word_far USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT far AS kept FROM judged
"""


SQL = _sql()
