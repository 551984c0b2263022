"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. Its bit and the measurements behind it are stored; a policy is only a
mask over those bits, so a new version of a policy, or the question what one rule costs, reads the ledger and
never the texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millpulse.llm.text import WORD_GAP_CHARS, words

# Fixed values of the measurements.
SYMBOLS = "#*$%&|<>"
WINDOW = 3
MIN_WORDS = 50
REPEAT_PERCENT = 50


def _repeated_starts(sorted_grams: Column) -> Column:
    """Where windows that occur twice or more begin, in order, from the windows sorted with their positions."""
    hits = F.filter(
        sorted_grams,
        lambda x, i: (x.gram == F.get(sorted_grams, i - 1).gram) | (x.gram == F.get(sorted_grams, i + 1).gram),
    )
    return F.array_sort(F.transform(hits, lambda x: x.at))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """All measurements of each row, beside the row's own columns; measurements replace columns of the same name.

    A NULL text has no words, lines or symbols, so every measurement is 0. Nothing is shuffled: the windows of a
    text are sorted inside its own row, so a very long text costs n log n and no other row waits for it.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    has_word = lambda line: F.translate(line, WORD_GAP_CHARS, "") != ""
    staged = docs.withColumns({
        "_words": words(F.col(text)),
        "_lines": F.filter(F.split(body, "\n"), has_word),
        "_solid": F.translate(body, WORD_GAP_CHARS, ""),
    })
    # Windows of equal words become neighbours once they are sorted.
    staged = staged.withColumn(
        "_grams",
        F.sort_array(F.slice(
            F.transform("_words", lambda w, i: F.struct(
                F.concat_ws(" ", w, F.get("_words", i + 1), F.get("_words", i + 2)).alias("gram"), i.alias("at"),
            )),
            F.lit(1), F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0)),
        )),
    )
    staged = staged.withColumn("_starts", _repeated_starts(F.col("_grams")))
    covered = F.aggregate(
        F.transform(
            "_starts", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", i + 1) - p, F.lit(WINDOW)))
        ),
        F.lit(0), lambda a, b: a + b,
    )
    letters = F.regexp_replace("_solid", r"\P{L}", "")
    staged = staged.withColumn("_letters", letters)
    measures = {
        "n_words": F.size("_words"),
        "word_chars": F.length("_solid"),
        "n_symbols": F.length("_solid") - F.length(F.translate("_solid", SYMBOLS, "")),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": covered,
        "n_lines": F.size("_lines"),
        "n_letters": F.length("_letters"),
        "n_upper": F.length(F.regexp_replace("_letters", r"\P{Lu}", "")),
        "n_marked_words": F.size(F.filter("_words", lambda w: w.rlike(r"[#*$%&|<>!]{2,}$"))),
    }
    # Generated columns stop a filter on the verdict from being pushed down, where it would measure again inside lambdas.
    row = F.struct(*[value.cast("long").alias(name) for name, value in measures.items()])
    own = [c for c in docs.columns if c not in measures]
    return staged.select(*own, F.inline(F.array(row)))


@dataclass(frozen=True)
class Rule:
    """A named failure condition over the measurements; its place in RULES is its bit."""

    name: str
    fails: Column


def rules() -> list[Rule]:
    c = F.col
    return [
        Rule("too_few_words", c("n_words") < MIN_WORDS),
        Rule("repeated_words", 100 * c("n_repeat_words") > REPEAT_PERCENT * c("n_words")),
        Rule("symbols", 4 * c("n_symbols") > c("n_words")),
        Rule("capitals", 2 * c("n_upper") > c("n_letters")),
        Rule("marked_words", 4 * c("n_marked_words") > c("n_words")),
        Rule("repeated_lines", 2 * c("n_dup_lines") > c("n_lines")),
        Rule("no_letters", 2 * c("n_letters") < c("word_chars")),
        Rule("long_words", c("word_chars") > 30 * c("n_words")),
    ]


RULE_NAMES = (
    "too_few_words", "repeated_words", "symbols", "capitals", "marked_words", "repeated_lines", "no_letters",
    "long_words",
)
BASE_RULES = RULE_NAMES[:2]
# Versions of the policy: the rules that a document must not fail.
POLICIES = {
    1: BASE_RULES,
    2: BASE_RULES + ("symbols", "capitals"),
    3: RULE_NAMES,
}
CURRENT_POLICY = 3


def mask(names: tuple[str, ...]) -> int:
    return sum(1 << RULE_NAMES.index(name) for name in names)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with their measurements and `failed_bits`, one bit per rule. A NULL measurement never occurs."""
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules()):
        bits = bits.bitwiseOR(F.when(rule.fails, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measure(docs, text).withColumn("failed_bits", bits)


def passes(policy: int = CURRENT_POLICY) -> Column:
    """True where no bit of the policy is set."""
    return F.col("failed_bits").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def apply_policy(rows: DataFrame, policy: int = CURRENT_POLICY) -> DataFrame:
    """The ledger with `base_failed` and the verdict `kept` of one version of the policy."""
    base = F.col("failed_bits").bitwiseAND(F.lit(mask(BASE_RULES))) != 0
    return rows.withColumn("base_failed", base).withColumn("kept", ~base & passes(policy))


def ablations(rows: DataFrame, policy: int = CURRENT_POLICY) -> DataFrame:
    """What each rule of a policy costs: rows failing it, failing it alone, and kept without it.

    The ledger is first counted per bit pattern, at most one row per pattern and task, and all rules are answered
    from those counts.
    """
    whole = mask(POLICIES[policy])
    patterns = rows.groupBy(F.col("failed_bits").bitwiseAND(F.lit(whole)).alias("bits")).agg(F.count("*").alias("n"))
    rule = F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.lit(mask((name,))).cast("long").alias("bit")) for name in POLICIES[policy]
    ]))
    pairs = patterns.select("bits", "n", rule.alias("r")).select("bits", "n", "r.rule", "r.bit")
    hit = F.col("bits").bitwiseAND(F.col("bit"))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).alias
    return pairs.groupBy("rule").agg(
        total(hit != 0)("failing"),
        total(F.col("bits") == F.col("bit"))("failing_alone"),
        total(F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0)("kept_without"),
    )
