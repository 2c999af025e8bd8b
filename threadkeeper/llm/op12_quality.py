"""Quality rules compiled into one Spark projection.

``RULES`` is a threshold table: each row bounds one measure of a text by a
percentage of another (symbols by words, repeated lines by lines, and so on).
``rule_columns`` compiles the table into boolean expressions; ``measures``
holds the counts they read.  Everything is built-in SQL expressions inside one
narrow projection: no shuffle and no user function, and a row is judged on its
whole text alone, so skew does not matter.

Words are maximal runs outside space and 0x09-0x0D, lines what newline
characters separate.  A word is repeated if it stands in an 8-word window that
the text holds twice or more.  Windows are found without comparing all pairs:
each window's hash and start are packed into one long (33 and 31 bits), the
longs are sorted, and windows whose 33 bits are shared are then compared by
their words, so a collision of hashes changes nothing.

Defined results: a null text has no word and no line and fails the base rules;
texts of one very long line or word, ties and repeated rows are judged like
any other; an empty table gives no rows; extra columns of the input are passed
on by ``judge`` and not read by the query.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shield, table

BLANKS = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of words in repeated windows
# Frequent function words of the four languages (fixed values; a parameter of ``measures``).
STOP_WORDS = (
    "the", "of", "and", "to", "a", "in", "is", "that", "for", "it", "was", "on", "with", "be", "as", "by",
    "der", "die", "und", "den", "von", "zu", "das", "sich", "mit", "auf", "des", "ist", "nicht", "ein", "eine",
    "de", "la", "le", "et", "les", "en", "un", "du", "une", "que", "pour", "est", "qui", "dans",
    "el", "y", "los", "se", "del", "las", "por", "no", "con", "su",
)


@dataclass(frozen=True)
class Rule:
    """``part`` must lie between ``least`` and ``most`` percent of ``whole``."""

    name: str
    part: str
    whole: str
    least: int | None = None
    most: int | None = None


RULES = (
    Rule("word_length", "word_chars", "n_words", least=300, most=1000),
    Rule("symbols", "n_symbols", "n_words", most=10),
    Rule("exclamations", "n_exclaims", "n_words", most=25),
    Rule("stop_words", "n_stop_words", "n_words", least=4),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=40),
    Rule("bullet_lines", "n_bullets", "n_lines", most=90),
    Rule("cut_lines", "n_ellipses", "n_lines", most=30),
)
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_exclaims", "n_bullets", "n_ellipses",
)


def let(value: Column, body) -> Column:
    """``body`` of ``value`` evaluated once: a name that lambdas inside may use."""
    return F.get(F.transform(F.array(value), body), 0)


def _count(text: Column, pattern: str) -> Column:
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def _matching(lines: Column, pattern: str) -> Column:
    return F.size(F.filter(lines, lambda line: F.rlike(line, F.lit(pattern))))


def repeated_words(words: Column) -> Column:
    """Number of words inside windows that ``words`` (a name, not an expression) holds twice or more."""
    low = F.lit((1 << 31) - 1)
    last = F.size(words) - WINDOW
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    # hashes of 2, 4 and 8 words, each from two of the level before
    wider = lambda hs, n: F.transform(hs, lambda h, i: F.xxhash64(h, F.get(hs, i + n)))
    packed = lambda hs: F.transform(starts, lambda i: F.get(hs, i).bitwiseAND(F.lit(~((1 << 31) - 1))).bitwiseOR(i.cast("long")))
    twice = lambda xs, same: F.filter(xs, lambda x, i: F.coalesce(same(x, F.get(xs, i - 1)), F.lit(False)) | F.coalesce(same(x, F.get(xs, i + 1)), F.lit(False)))
    near = lambda xs: twice(xs, lambda a, b: F.shiftright(a, 31) == F.shiftright(b, 31))
    text = lambda at: F.array_join(F.slice(words, at + 1, WINDOW), " ")
    named = lambda xs: F.sort_array(F.transform(xs, lambda x: let(x.bitwiseAND(low).cast("int"), lambda at: F.struct(text(at).alias("k"), at.alias("at")))))
    equal = lambda xs: F.sort_array(F.transform(twice(xs, lambda a, b: a["k"] == b["k"]), lambda x: x["at"]))
    covered = lambda at: F.aggregate(
        F.transform(at, lambda a, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - a, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda s, n: s + n
    )
    ordered = let(hashes, lambda h1: let(wider(h1, 1), lambda h2: let(wider(h2, 2), lambda h4: let(wider(h4, 4), lambda h8: F.sort_array(packed(h8))))))
    return let(ordered, lambda s: let(near(s), lambda c: F.when(F.size(c) == 0, F.lit(0).cast("long")).otherwise(let(named(c), lambda k: let(equal(k), covered)))))


def measures(text: Column, stop_words: tuple[str, ...] = STOP_WORDS) -> Column:
    """Struct of the counts of a text (``MEASURES``), whole text, null as empty."""
    t = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(t, BLANKS), "")
    lines = F.filter(F.split(t, "\n"), lambda line: F.rlike(line, F.lit(WORD)))

    def counts(w: Column, ls: Column) -> Column:
        values = {
            "n_words": F.size(w),
            "word_chars": F.char_length(F.regexp_replace(t, BLANKS, "")),
            "n_symbols": _count(t, SYMBOLS),
            "n_dup_lines": F.size(ls) - F.size(F.array_distinct(ls)),
            "n_repeat_words": repeated_words(w),
            "n_lines": F.size(ls),
            "n_stop_words": F.size(F.filter(w, lambda x: F.lower(F.rtrim(x, F.lit(".,;:"))).isin(*stop_words))),
            "n_exclaims": _count(t, "!"),
            "n_bullets": _matching(ls, "^[\\x20\\x09]*[-*•]"),
            "n_ellipses": _matching(ls, "(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$"),
        }
        return F.struct(*[values[m].cast("long").alias(m) for m in MEASURES])

    return let(words, lambda w: let(lines, lambda ls: counts(w, ls)))


def rule_columns(rules: tuple[Rule, ...], value) -> dict[str, Column]:
    """The table as expressions: true where a text breaks the rule.  ``value``
    gives a measure's column.  Products of whole numbers, no division."""
    out = {}
    for r in rules:
        part, whole = F.lit(100) * value(r.part), value(r.whole)
        low = F.lit(False) if r.least is None else part < F.lit(r.least) * whole
        high = F.lit(False) if r.most is None else part > F.lit(r.most) * whole
        out[r.name] = low | high
    return out


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with its measures, base_failed, failed_rules (names, comma-joined,
    in the table's order) and kept; columns of these names in the input go."""
    names = [*MEASURES, "base_failed", "failed_rules", "kept"]
    clear, restore = shield(docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names]), text)
    hidden = [c for c in clear.columns]
    m = lambda name: F.col("_m")[name]
    measured = clear.withColumn("_m", measures(F.col(f"`{text}`")))
    base = (m("n_words") < LEAST_WORDS) | (F.lit(100) * m("n_repeat_words") > F.lit(MOST_REPEATED) * m("n_words"))
    broken = rule_columns(rules, m)
    judged = measured.select(
        *[F.col(f"`{c}`") for c in hidden],
        *[m(x).alias(x) for x in MEASURES],
        base.alias("base_failed"),
        F.concat_ws(",", *[F.when(c, F.lit(n)) for n, c in broken.items()]).alias("failed_rules"),
    )
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))
    original = [c for c in docs.columns if c not in names]
    return judged.select(*[F.col(f"`{h}`").alias(o) for h, o in zip(hidden, original)], *names)


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdict on every whole text of ``documents``."""
    out = judge(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.drop("text")


def _rules_sql(rules: tuple[Rule, ...] = RULES) -> str:
    parts = []
    for r in rules:
        tests = ([f"100 * {r.part} < {r.least} * {r.whole}"] if r.least is not None else []) + ([f"100 * {r.part} > {r.most} * {r.whole}"] if r.most is not None else [])
        parts.append(f"CASE WHEN {' OR '.join(tests)} THEN '{r.name}' END")
    return "concat_ws(',', " + ", ".join(parts) + ")"


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
                list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), win AS (
  SELECT r, unnest(range(1, len(words) - 6)) AS p, words FROM w WHERE len(words) >= 8
), rep AS (
  SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, list_slice(words, p, p + 7)) AS c FROM win) WHERE c > 1
), cov AS (
  SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + 8)) AS q FROM rep) GROUP BY r
), m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
         len(list_filter(words, lambda x: list_contains([STOP], lower(rtrim(x, '.,;:')))))::BIGINT AS n_stop_words,
         (length(t) - length(replace(t, '!', '')))::BIGINT AS n_exclaims,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•]')))::BIGINT AS n_bullets,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$')))::BIGINT AS n_ellipses
  FROM w LEFT JOIN cov USING (r)
), j AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, RULES AS failed_rules FROM m)
SELECT *, NOT base_failed AND failed_rules = '' AS kept FROM j
""".replace("STOP", ", ".join(f"'{w}'" for w in STOP_WORDS)).replace("RULES", _rules_sql())
