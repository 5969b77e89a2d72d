"""Quality rules: a threshold table compiled into one projection.

Everything is DataFrame expressions; no row leaves the JVM.  The repeated-word
measure sorts each text's three-word windows inside its own row, so nothing is
shuffled and a hot source costs no more than its own text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, table, words

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = tuple(
    "the of and to in is that for with as was on are by this be it from an a "
    "der die und den das von zu mit des im ist nicht ein eine auf für dem als auch es an "
    "de la le et les des en un une du que est pour dans qui sur par au pas avec "
    "el los y del se las por con no una su para al lo como más".split()
)


@dataclass(frozen=True)
class Rule:
    """A document passes if low <= metric <= high; None leaves a side open."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: The production thresholds.  Metrics are the columns that ``metrics`` computes.
RULES = (
    Rule("word_count", "n_words", low=50),
    Rule("mean_word_length", "mean_word_chars", low=2.5, high=12),
    Rule("symbols_per_word", "symbol_ratio", high=0.3),
    Rule("exclamations_per_word", "bang_ratio", high=0.25),
    Rule("stop_words", "stop_ratio", low=0.03),
    Rule("duplicate_lines", "dup_line_ratio", high=0.5),
    Rule("repeated_words", "repeat_ratio", high=0.5),
    Rule("bullet_lines", "bullet_ratio", high=0.9),
    Rule("ellipsis_lines", "ellipsis_ratio", high=0.3),
)

_INDEX_BITS = 20


def _covered(places: Column) -> Column:
    """How many words the three-word windows at these sorted places cover."""
    return let(
        places,
        lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.when(k == 0, F.lit(3)).otherwise(F.least(F.lit(3), (x - F.get(p, k - 1)).cast("int")))),
            F.lit(0).cast("long"),
            lambda total, x: total + x,
        ),
    )


def _window(w: Column, i: Column) -> list[Column]:
    return [F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)]


def repeat_words(w: Column, n: Column) -> Column:
    """Words inside three-word windows that occur at least twice in the same text.

    Windows are sorted as hash and place packed in one long; neighbours with
    equal hashes are compared word by word, and a text where two different
    windows share a hash, or too long for the packed place, sorts the windows
    themselves instead.  Both ways give the same exact count.
    """
    places = F.sequence(F.lit(0), n - 3)
    mask = F.lit((1 << _INDEX_BITS) - 1).cast("long")
    place = lambda x: x.bitwiseAND(mask).cast("int")
    key = lambda x: F.shiftright(x, _INDEX_BITS)

    packed = F.sort_array(F.transform(places, lambda i: F.shiftleft(F.xxhash64(*_window(w, i)), _INDEX_BITS).bitwiseOR(i.cast("long"))))
    twins = let(
        packed,
        lambda s: F.filter(s, lambda x, k: F.coalesce(key(x) == key(F.get(s, k - 1)), F.lit(False)) | F.coalesce(key(x) == key(F.get(s, k + 1)), F.lit(False))),
    )
    same = lambda a, b: (F.get(w, a) == F.get(w, b)) & (F.get(w, a + 1) == F.get(w, b + 1)) & (F.get(w, a + 2) == F.get(w, b + 2))
    clash = lambda t: F.exists(
        F.sequence(F.lit(1), F.size(t) - 1),
        lambda k: (key(F.get(t, k)) == key(F.get(t, k - 1))) & ~same(place(F.get(t, k)), place(F.get(t, k - 1))),
    )

    whole = F.array_sort(F.transform(places, lambda i: F.struct(F.concat_ws(" ", *_window(w, i)).alias("w"), i.alias("i"))))
    exact = let(
        whole,
        lambda s: _covered(
            F.sort_array(
                F.transform(
                    F.filter(s, lambda x, k: F.coalesce(x["w"] == F.get(s, k - 1)["w"], F.lit(False)) | F.coalesce(x["w"] == F.get(s, k + 1)["w"], F.lit(False))),
                    lambda x: x["i"],
                )
            )
        ),
    )
    fast = let(
        twins,
        lambda t: F.when(F.size(t) == 0, F.lit(0).cast("long")).when(clash(t), F.lit(-1).cast("long")).otherwise(_covered(F.sort_array(F.transform(t, place)))),
    )
    quick = F.when(n < 1 << _INDEX_BITS, fast).otherwise(F.lit(-1).cast("long"))
    return F.when(n < 4, F.lit(0).cast("long")).otherwise(let(quick, lambda q: F.when(q >= 0, q).otherwise(exact)))


def metrics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The measures that rules name, as columns beside those of ``docs``.

    Columns of the same name in ``docs`` are replaced.  A null text counts as
    empty: no words, no lines, ratios 0.
    """
    plain = F.coalesce(F.col(text_col), F.lit(""))
    bytes_of = lambda pattern: (F.octet_length(plain) - F.octet_length(F.regexp_replace(plain, pattern, ""))).cast("long")
    out = docs.withColumns(
        {
            "_words": words(F.col(text_col)),
            "_lines": F.filter(F.split(plain, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
            "n_symbols": bytes_of(r"[#*$%&|<>]+"),
            "_bangs": bytes_of("!+"),
        }
    )
    n, lines = F.size("_words"), F.size("_lines")
    out = out.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_dup_lines": (lines - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": repeat_words(F.col("_words"), n),
            "_stops": F.size(F.filter("_words", lambda x: F.lower(x).isin(*STOP_WORDS))),
            "_bullets": F.size(F.filter("_lines", lambda x: x.rlike(r"^[\x20\x09]*[-*•‣▪◦]"))),
            "_ellipses": F.size(F.filter("_lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09\x0D]*$"))),
            "_n_lines": lines,
        }
    )
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    out = out.withColumns(
        {
            "mean_word_chars": ratio("word_chars", "n_words"),
            "symbol_ratio": ratio("n_symbols", "n_words"),
            "bang_ratio": ratio("_bangs", "n_words"),
            "stop_ratio": ratio("_stops", "n_words"),
            "dup_line_ratio": ratio("n_dup_lines", "_n_lines"),
            "repeat_ratio": ratio("n_repeat_words", "n_words"),
            "bullet_ratio": ratio("_bullets", "_n_lines"),
            "ellipsis_ratio": ratio("_ellipses", "_n_lines"),
        }
    )
    return out.drop("_words", "_lines", "_bangs", "_stops", "_bullets", "_ellipses", "_n_lines")


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """The names of the rules that a row of measures breaks, as one expression."""
    broken = []
    for r in rules:
        ok = F.lit(True)
        if r.low is not None:
            ok = ok & (F.col(r.metric) >= r.low)
        if r.high is not None:
            ok = ok & (F.col(r.metric) <= r.high)
        broken.append(F.when(~ok, F.lit(r.name)))
    return F.array_compact(F.array(*broken)) if broken else F.expr("cast(array() as array<string>)")


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """``docs`` with measures, ``broken_rules``, ``base_failed`` and ``kept``.

    base_failed: fewer than 50 words, or over half the words inside repeated
    three-word windows.  kept: not base_failed and no rule broken.  Null and
    empty texts have no words, so they fail; an empty table gives an empty one;
    repeated rows are judged each on its own; columns that clash with a measure
    are replaced by it.
    """
    out = metrics(docs, text_col).withColumn("broken_rules", compile_rules(rules))
    base = (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))
    return out.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document judged by the production rules."""
    return quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


_STOPS_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)
OP1_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), p AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), r AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM p) WHERE n > 1
), c AS (
  SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM r) GROUP BY rid
), m AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (length(t) - length(replace(t, '!', '')))::BIGINT AS bangs,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: lower(x) IN ({_STOPS_SQL}))) AS stops,
         len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•‣▪◦]'))) AS bullets,
         len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09\x0D]*$'))) AS ellipses, len(l) AS lines
  FROM d LEFT JOIN c USING (rid)
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 2.5 AND 12 AND n_symbols / n_words <= 0.3
       AND bangs / n_words <= 0.25 AND stops / n_words >= 0.03 AND n_dup_lines / lines <= 0.5
       AND n_repeat_words / n_words <= 0.5 AND bullets / lines <= 0.9 AND ellipses / lines <= 0.3 AS kept
FROM b
"""
