"""Quality rules: a table of thresholds compiled into one projection.

Each measure is an expression over the text (length, symbols, stop words, lines); each
rule bounds one measure. ``compile_rules`` turns the whole table into two columns, so
Spark evaluates every rule in the scan's own pass: no shuffle and no user function.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake.llm.common import BLANKS, hash64, shielded, shifted, split_words, where_computed

SYMBOLS = "#*$%&|<>"

# Frequent function words by language.
STOP_WORDS = {
    "en": "a all an and are as at be but by for from had have he her his in is it not of on or she that the they this to was we were which with you".split(),
    "de": "als am an auch auf aus bei das dem den der des die ein eine einen er es für im in ist mit nach nicht sich sie und von war werden wie wird zu zum zur".split(),
    "fr": "au aux avec ce ces dans de des du elle en est et il la le les mais ne nous ou par pas plus pour qu que qui sa se ses son sur un une".split(),
    "es": "a al como con de del el en es ha la las lo los mas no o para pero por que se sin sobre su sus un una y ya".split(),
}


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie within ``low`` and ``high``; a NULL measure passes."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


# Bounds meant to leave any ordinary prose alone.
RULES = (
    Rule("word_length", "mean_word_chars", 2.0, 12.0),
    Rule("symbols", "symbol_ratio", None, 0.1),
    Rule("stop_words", "stop_word_ratio", 0.03, None),
    Rule("duplicate_lines", "dup_line_ratio", None, 0.5),
)


def with_repeated_words(df: DataFrame, words: str, name: str) -> DataFrame:
    """Adds the number of words that lie in a 3-word window found at least twice in the array.

    Windows are compared by a 64-bit hash (two different windows of one text would have
    to agree in it). Texts whose windows all differ stop at one linear hash-set pass;
    only the others sort their windows. The steps are columns of their own because an
    expression used twice would be computed twice, and inside a lambda once per element.
    """
    pairs = F.zip_with(words, shifted(F.col(words), 1), lambda a, b: hash64(a, b))
    triples = F.zip_with(pairs, shifted(F.col(words), 2), lambda p, c: hash64(p, c))
    w = F.col("_windows")
    none_twice = F.size(F.array_distinct(w)) == F.size(w)
    placed = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = F.filter(
        F.zip_with("_ordered", shifted(F.col("_ordered"), 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))),
        lambda x: x.isNotNull(),
    )
    covered = F.zip_with("_starts", shifted(F.col("_starts"), 1), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    return (
        df.withColumn("_windows", F.slice(triples, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))))
        .withColumn("_ordered", F.when(~none_twice, placed))
        .withColumn("_starts", F.sort_array(F.array_distinct(F.flatten(found))))
        .withColumn(name, F.coalesce(F.aggregate(covered, F.lit(0), lambda s, x: s + x), F.lit(0)))
        .drop("_windows", "_ordered", "_starts")
    )


def stop_words(words: Column, lang: Column) -> Column:
    """Number of stop words of the row's language; NULL where the language has no list."""


    def found(listed: list[str]) -> Column:
        return F.size(F.filter(words, lambda word: F.lower(word).isin(listed)))

    out = F.lit(None).cast("int")
    for code, listed in STOP_WORDS.items():
        out = F.when(lang == code, found(listed)).otherwise(out)
    return out


def with_measures(df: DataFrame, text: str = "text", lang: str | None = "lang") -> DataFrame:
    """``df`` plus ``_q``, a struct of all measures."""
    body = F.coalesce(F.col(text), F.lit(""))
    language = F.col(lang) if lang and lang in df.columns else F.lit(None).cast("string")
    words = df.withColumn("_words", split_words(body)).withColumn(
        "_lines", F.filter(F.split(body, "\n", -1), lambda line: F.length(F.btrim(line, F.lit(BLANKS))) > 0)
    )
    counted = with_repeated_words(words, "_words", "_repeated").withColumn(
        "_q",
        F.struct(
            F.size("_words").cast("long").alias("n_words"),
            F.length(F.translate(body, BLANKS, "")).cast("long").alias("word_chars"),
            (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            F.size("_lines").cast("long").alias("n_lines"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.col("_repeated").cast("long").alias("n_repeat_words"),
            stop_words(F.col("_words"), language).cast("long").alias("n_stop_words"),
        ),
    ).drop("_words", "_lines", "_repeated")
    q = F.col("_q")
    return counted.withColumn(
        "_q",
        q.withField("mean_word_chars", q["word_chars"] / F.nullif(q["n_words"], F.lit(0)))
        .withField("symbol_ratio", q["n_symbols"] / F.nullif(q["n_words"], F.lit(0)))
        .withField("stop_word_ratio", q["n_stop_words"] / F.nullif(q["n_words"], F.lit(0)))
        .withField("dup_line_ratio", q["n_dup_lines"] / F.nullif(q["n_lines"], F.lit(0))),
    )


def compile_rules(rules: tuple[Rule, ...], measures: Column) -> Column:
    """The names of the rules that a row breaks, as one array expression."""
    broken = []
    for rule in rules:
        value = measures[rule.measure]
        outside = F.lit(False)
        if rule.low is not None:
            outside = outside | (value < rule.low)
        if rule.high is not None:
            outside = outside | (value > rule.high)
        broken.append(F.when(outside, F.lit(rule.name)))
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def _with_verdict(df: DataFrame, rules: tuple[Rule, ...], text: str, lang: str | None) -> DataFrame:
    """``df``, whose names are shielded, plus ``_verdict``."""
    q = F.col("_q")
    base = (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])
    broken = compile_rules(rules, q)
    verdict = q.withField("base_failed", base).withField("broken", broken).withField("kept", ~base & (F.size(broken) == 0))
    return with_measures(df, text, lang).withColumn("_verdict", verdict)


def judge(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", lang: str | None = "lang") -> DataFrame:
    """Adds ``quality``: the measures, ``base_failed``, the broken ``rules`` and ``kept``.

    Base: fewer than 50 words, or more than half of the words in repeated 3-word
    windows. A NULL or empty text has no words and fails. A NULL language, or one
    without a stop-word list, is not judged by stop words. Rows that repeat are judged
    each; no row is added or lost; an existing ``quality`` column is replaced. Other
    columns pass through whatever their names.
    """
    inside, back = shielded(df, text, *([lang] if lang else []))
    judged = _with_verdict(inside, rules, text, lang)
    return judged.select(*[c for name, c in back.items() if name != "quality"], F.col("_verdict").alias("quality"))


def keep_good(df: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that pass, with all the columns they came with, ``quality`` included."""
    inside, back = shielded(df, "text", "lang")
    return where_computed(_with_verdict(inside, rules, "text", "lang"), F.col("_verdict.kept")).select(*back.values())
