"""Quality rules as a ledger of bits, with DataFrame functions only.

Every rule is evaluated once per document. ``ledger`` keeps the measurements and one bit per
failed rule; a policy is a versioned set of rules, applied later by a bitwise AND, so that a new
policy or the ablation of one rule needs no second look at any text.

Null and empty texts, and texts of blanks, have no words: all counts are 0 and ``few_words`` fails.
Texts of any length are measured whole: windows are compared by sorting, never pair by pair.
Repeated rows give repeated results, an empty table an empty one. Only id and text are read;
further columns of any name do no harm and do not appear in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
SYMBOLS = "#*$%&|<>"
BLANK_RUN = r"[\x20\x09-\x0D]+"

# Name -> condition of failure, over the measurements. The order gives the bits.
RULES = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "many_symbols": "100 * n_symbols > 20 * n_words",
    "repeated_lines": "100 * n_dup_lines > 60 * n_lines",
    "many_capitals": "100 * n_capitals > 30 * word_chars",
    "many_exclamations": "100 * n_exclamations > 20 * n_words",
    "odd_word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
}
BASE = ("few_words", "repeated_windows")
# Version -> rules that reject a document.
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "many_symbols", "repeated_lines", "many_capitals"),
    "v2": tuple(RULES),
}


def mask(rules: tuple[str, ...] | list[str]) -> int:
    """The bits of some rules."""
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in rules)


def _removed(text: Column, characters: str) -> Column:
    """How many of some characters a text has."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("bigint")


def measurements(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the counts that the rules use."""
    parts = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    parts = parts.select(
        "*", F.array_remove(F.split("_text", BLANK_RUN), "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
        .alias("_lines"))
    parts = parts.select("*", F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"))
    last = F.size("_hashes") - WINDOW
    windows = F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)])))
    parts = parts.select("*", windows.alias("_windows"))
    # Equal windows are neighbours once sorted; most documents have none and sort nothing.
    some = F.size("_windows") > F.size(F.array_distinct("_windows"))
    in_order = F.when(some, F.sort_array(F.transform(
        "_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))))
    parts = parts.select("*", in_order.alias("_sorted"))
    twice = F.filter("_sorted", lambda x, i: (
        (F.get("_sorted", i - 1)["w"] == x["w"]) | (F.get("_sorted", i + 1)["w"] == x["w"])))
    parts = parts.select(
        "*", F.sort_array(F.transform(twice, lambda x: x["i"])).alias("_places"))
    # A window covers its words up to the next repeated window.
    covered = F.aggregate(
        F.transform("_places", lambda at, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get("_places", i + 1) - at, F.lit(WINDOW)))),
        F.lit(0).cast("bigint"), lambda total, n: total + n)
    long = "bigint"
    return parts.select(
        id_col, F.size("_words").cast(long).alias("n_words"),
        F.length(F.array_join("_words", "")).cast(long).alias("word_chars"),
        _removed(F.col("_text"), SYMBOLS).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast(long).alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast(long).alias("n_repeat_words"),
        F.size("_lines").cast(long).alias("n_lines"),
        F.length(F.regexp_replace("_text", "[^A-Z]+", "")).cast(long).alias("n_capitals"),
        _removed(F.col("_text"), "!").alias("n_exclamations"))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``measurements`` with ``failed``, the bits of the failed rules."""
    bits = F.lit(0).cast("bigint")
    for bit, condition in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << bit)).otherwise(F.lit(0)))
    return measurements(docs, id_col, text_col).withColumn("failed", bits)


def passes(policy: str, failed: Column | str = "failed") -> Column:
    """Whether no rule of a policy failed."""
    failed = F.col(failed) if isinstance(failed, str) else failed
    return failed.bitwiseAND(F.lit(mask(POLICIES[policy])).cast("bigint")) == 0


def ablations(ledgers: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: how many documents fail it, fail it alone, and how many the policy
    would keep without it. Ledgers are counted by their bits first: few rows go on."""
    rules = POLICIES[policy]
    whole = mask(rules)
    counts = ledgers.groupBy(F.col("failed").bitwiseAND(F.lit(whole)).alias("_bits")).agg(
        F.count("*").alias("_n"))
    rows = F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(mask([r])).cast("bigint").alias("bit"))
        for r in rules]))
    each = counts.select("_bits", "_n", rows.alias("r")).select("_bits", "_n", "r.*")
    others = F.col("_bits").bitwiseAND(F.bitwise_not("bit"))

    def number(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("_n"))), F.lit(0))
    return each.groupBy("rule").agg(
        number(F.col("_bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        number(F.col("_bits") == F.col("bit")).alias("n_failed_alone"),
        number(others == 0).alias("n_kept_without"))


def report(docs: DataFrame, policy: str = "v2") -> DataFrame:
    """Counts, the base verdict and that of a policy."""
    return ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes("base")).alias("base_failed"), passes(policy).alias("kept"),
        "n_lines", "n_capitals", "n_exclamations", "failed")


ORACLE = r"""
with t as (select doc_id, coalesce(text, '') as t from documents),
p as (select doc_id, t,
    list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
  from t),
w as (select doc_id, i, count(*) over (partition by doc_id, list_slice(ws, i, i + 7)) as c
  from (select doc_id, ws, unnest(range(1, len(ws) - 6)) as i from p)),
r as (select doc_id, count(distinct i + o) as n
  from w, (select unnest(range(0, 8)) as o) where c > 1 group by doc_id),
m as (select p.doc_id, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
    len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words,
    len(ls) as n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) as n_capitals,
    length(t) - length(replace(t, '!', '')) as n_exclamations
  from p left join r using (doc_id)),
f as (select *, """ + " | ".join(
    f"(case when {rule} then {1 << bit} else 0 end)" for bit, rule in enumerate(RULES.values())
) + f""" as failed from m)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars,
  n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
  n_repeat_words::bigint as n_repeat_words, (failed & {mask(BASE)}) <> 0 as base_failed,
  (failed & {mask(POLICIES["v2"])}) = 0 as kept, n_lines::bigint as n_lines,
  n_capitals::bigint as n_capitals, n_exclamations::bigint as n_exclamations,
  failed::bigint as failed from f"""
