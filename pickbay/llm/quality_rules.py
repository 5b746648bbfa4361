"""Quality rules with a bitmask ledger (no Python in tasks).

Every rule is evaluated once per document: the ledger keeps the measurements and
one failure bit per rule.  Policies are versioned sets of rules, i.e. bitmasks;
applying one, or asking what a rule adds to it, only reads the bits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

#: Hash of the three words from word w at position i on (windows with equal hashes are compared by their words).
WINDOW_HASH = "xxhash64(w, get(words, i + 1), get(words, i + 2))"

#: Name and failure condition of each rule; its position is its bit.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 30 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
    ("upper_case", "100 * n_upper > 60 * n_letters"),
    ("exclamations", "100 * n_exclaims > 50 * n_words"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


def mask(*names: str) -> int:
    return sum(BIT[n] for n in names)


#: Versioned policies: a document fails a policy if it fails any of its rules.
BASE = mask("few_words", "repeated_windows")
POLICIES = {
    "v1": BASE | mask("symbols", "duplicate_lines"),
    "v2": BASE | mask("symbols", "duplicate_lines", "short_words", "long_words", "upper_case", "exclamations"),
}
CURRENT = "v2"


def measurements(docs: DataFrame) -> DataFrame:
    """doc_id and all measurements of the whole text, each step computed once per row."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    d = d.withColumn("words", F.array_remove(F.split("text", SPACES), ""))
    d = d.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = d.withColumn("n_words", F.size("words").cast("long"))
    # a window's key holds the low bits of its hash above and its position below; only windows that share
    # the hash with another one are looked at word by word
    d = d.withColumn("bits", F.length(F.bin("n_words")))
    d = d.withColumn("keys", F.expr(f"""
        sort_array(slice(transform(words, (w, i) -> shiftleft(
            {WINDOW_HASH}, bits) | i), 1, greatest(size(words) - 2, 0)))"""))
    d = d.withColumn("alike", F.expr("""
        filter(keys, (k, i) -> shiftright(k, bits) = shiftright(get(keys, i - 1), bits)
                            OR shiftright(k, bits) = shiftright(get(keys, i + 1), bits))"""))
    d = d.withColumn("at", F.expr("transform(alike, k -> cast(k & (shiftleft(1L, bits) - 1) as int))"))
    # different windows with one hash (neighbours in hash order, then position)
    d = d.withColumn("clash", F.expr("""
        exists(sequence(1, greatest(size(alike) - 1, 1)), i ->
            shiftright(get(alike, i), bits) = shiftright(get(alike, i - 1), bits)
            AND NOT (get(words, get(at, i)) = get(words, get(at, i - 1))
                     AND get(words, get(at, i) + 1) = get(words, get(at, i - 1) + 1)
                     AND get(words, get(at, i) + 2) = get(words, get(at, i - 1) + 2)))"""))
    d = d.withColumn("exact", F.expr("""
        CASE WHEN clash THEN sort_array(transform(at, i -> named_struct(
            'a', get(words, i), 'b', get(words, i + 1), 'c', get(words, i + 2), 'i', i))) END"""))
    d = d.withColumn("found", F.expr("""
        sort_array(CASE WHEN clash THEN transform(filter(exact, (x, j) ->
            (x.a = get(exact, j - 1).a AND x.b = get(exact, j - 1).b AND x.c = get(exact, j - 1).c)
            OR (x.a = get(exact, j + 1).a AND x.b = get(exact, j + 1).b AND x.c = get(exact, j + 1).c)), x -> x.i)
        ELSE at END)"""))
    covered = F.expr("""
        CASE WHEN size(found) = 0 THEN 0L ELSE
            aggregate(zip_with(slice(found, 2, size(found)), slice(found, 1, size(found) - 1), (b, a) -> least(b - a, 3)),
                      3L, (s, x) -> s + x) END""")
    return d.select(
        "doc_id", "n_words", F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.regexp_count("text", F.lit(r"\p{L}")).cast("long").alias("n_letters"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit("!")).cast("long").alias("n_exclaims"))


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements and fail_bits (bit i: rule i of RULES failed), one row per document.

    Defined cases: a null or empty text has zero in every measurement (and fails
    few_words only); repeated rows and null doc_ids are rows like others; a text
    of any length is measured whole; an empty table gives an empty ledger;
    columns other than doc_id and text are ignored, whatever their names.
    """
    bits = reduce(lambda a, b: a.bitwiseOR(b), (
        F.when(F.expr(test), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long") for name, test in RULES))
    return measurements(docs).withColumn("fail_bits", bits)


def apply_policy(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """base_failed, policy, policy_bits (rules of the policy that failed), sole_bit and kept."""
    of = F.col("fail_bits").bitwiseAND(F.lit(POLICIES[policy]).cast("long"))
    return (entries.withColumn("base_failed", F.col("fail_bits").bitwiseAND(F.lit(BASE).cast("long")) != 0)
            .withColumn("policy", F.lit(policy)).withColumn("policy_bits", of)
            # set if exactly one rule rejects the document: dropping it would keep it
            .withColumn("sole_bit", F.when(F.bit_count("policy_bits") == 1, F.col("policy_bits")).otherwise(F.lit(0).cast("long")))
            .withColumn("kept", ~F.col("base_failed") & (F.col("policy_bits") == 0)))


def ablation(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """One row per rule of a policy: documents it fails, documents only it fails,
    and documents kept without it - bit counts over the ledger, no rule run again."""
    of = F.col("fail_bits").bitwiseAND(F.lit(POLICIES[policy]).cast("long"))
    patterns = entries.groupBy(of.alias("bits")).agg(F.count("*").alias("n"))  # at most 2^rules rows
    rules = [(name, BIT[name]) for name, _ in RULES if BIT[name] & POLICIES[policy]]
    sums = [F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)) for _, bit in rules for cond in (
        F.col("bits").bitwiseAND(F.lit(bit)) != 0, F.col("bits") == bit, F.col("bits").bitwiseAND(F.lit(~bit)) == 0)]
    row = patterns.agg(F.array(*sums).alias("s"))
    table = F.array(*[F.struct(F.lit(name).alias("rule"), F.get("s", F.lit(3 * i)).alias("failed"),
                               F.get("s", F.lit(3 * i + 1)).alias("only_this"),
                               F.get("s", F.lit(3 * i + 2)).alias("kept_without")) for i, (name, _) in enumerate(rules)])
    return row.select(F.inline(table))


def quality_rules(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with a policy's verdict, one row per document."""
    return apply_policy(ledger(docs), policy)
