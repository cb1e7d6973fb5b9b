"""Quality rules as a ledger of failure bits, in DataFrame expressions only.

Method. ``ledger`` evaluates every rule once for each row and stores the measurements and
one bit for each failed rule. Policies are versioned sets of bits: ``verdict`` applies one
by a bitwise and, and ``ablation`` counts from the ledger alone what a policy rejects, what
it would reject without each of its rules, and what only that rule rejects: it aggregates
rows by their bits (at most 2^rules groups) and combines them by bitwise operations.

Words are runs of characters other than space, tab, LF, VT, FF and CR. A word is repeated
if it lies in a three-word window that the text holds twice or more. Sorting hashes with
their places gives the windows whose hash another one has, a few of all; those are sorted
again by their words, where equal ones are neighbours. So hashes save work and decide
nothing.

Everything is one narrow projection: no shuffle, no Python, whole texts.

Cases. Null, empty and blank texts have no words and fail ``few_words``. Repeated rows are
judged alike, a null id stays null, extra columns are ignored, empty tables give empty
results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
HASH = "xxhash64({})"
#: name -> condition on the measurements under which a text fails; the order gives the bits
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "5 * n_symbols > n_words",
    "repeated_lines": "n_dup_lines > 3 and 10 * n_dup_lines > 3 * n_lines",
    "capitals": "10 * n_capitals > 4 * word_chars",
    "exclamations": "3 * n_exclamations > n_words",
    "word_length": "word_chars < 2 * n_words or word_chars > 15 * n_words",
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}
#: version -> the rules that reject
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": tuple(RULES),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_exclamations")


def mask(policy: str | tuple[str, ...]) -> int:
    return sum(BITS[r] for r in (POLICIES[policy] if isinstance(policy, str) else policy))


def _without(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the measurements of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select(
        "id",
        "text",
        F.array_remove(F.split("text", SPACE), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0).alias("lines"),
    )
    # each array is a column before an expression over its elements refers to it, so that it is made once
    # 33 bits of hash and 31 of place
    window = "{w}, get(words, {p} + 1), get(words, {p} + 2)"
    rows = rows.withColumn("places", F.expr(f"sort_array(transform(slice(words, 1, greatest(size(words) - 2, 0)), (x, i) -> shiftleft({HASH.format(window.format(w='x', p='i'))}, 31) | cast(i as bigint)))"))
    same = "shiftright(v, 31) = shiftright(get(places, i {d} 1), 31)"
    rows = rows.withColumn("maybe", F.expr(f"transform(filter(places, (v, i) -> {same.format(d='-')} or {same.format(d='+')}), v -> cast(v & 2147483647 as int))"))
    # words hold no space, so windows that are equal are what begins alike up to the last space, and neighbours when sorted
    rows = rows.withColumn("named", F.expr(f"sort_array(transform(maybe, p -> concat_ws(' ', {window.format(w='get(words, p)', p='p')}, lpad(p, 10, '0'))))"))
    rows = rows.withColumn("named", F.expr("transform(named, x -> struct(substr(x, 1, length(x) - 10) as window, cast(substr(x, -10) as int) as place))"))
    rows = rows.withColumn("again", F.expr("sort_array(transform(filter(named, (x, i) -> x.window = get(named, i - 1).window or x.window = get(named, i + 1).window), x -> x.place))"))
    covered = F.expr("aggregate(again, struct(0L as n, -3 as last), (acc, p) -> struct(acc.n + least(3, p - acc.last) as n, p as last)).n")
    text = F.col("text")
    return rows.select(
        "id",
        F.size("words").cast("long").alias("n_words"),
        _without(text, r"[^\x20\x09-\x0D]").cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        (F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("n_capitals"),
        (F.length(text) - F.length(F.translate(text, "!", ""))).cast("long").alias("n_exclamations"),
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, the measurements and fail_bits of every row."""
    bits = " | ".join(f"if({rule}, {BITS[name]}L, 0L)" for name, rule in RULES.items())
    return measured(docs, id_col, text_col).withColumn("fail_bits", F.expr(bits))


def verdict(policy: str | tuple[str, ...], bits: str = "fail_bits") -> Column:
    """True for rows that a policy keeps."""
    return F.col(bits).bitwiseAND(F.lit(mask(policy))) == 0


def ablation(ledgers: DataFrame, policies: dict | None = None) -> DataFrame:
    """(policy, rule, rejected, without_rule, only_by_rule, also_failed): counts for each rule of each policy.

    also_failed is the union of the bits of the rows that the rule rejects.
    """
    spark = ledgers.sparkSession
    parts = [(p, r, mask(p if policies is None else rules), BITS[r]) for p, rules in (policies or POLICIES).items() for r in rules]
    rules = spark.createDataFrame(parts, "policy string, rule string, mask long, bit long")
    groups = ledgers.groupBy("fail_bits").agg(F.count("*").alias("n"))
    # at most 2^rules groups meet a row for each rule of each policy
    met = F.broadcast(rules).join(groups, F.col("fail_bits").bitwiseAND(F.col("mask")) != 0, "left")
    n = F.coalesce("n", F.lit(0))
    left = F.col("fail_bits").bitwiseAND(F.col("mask")).bitwiseAND(F.bitwise_not(F.col("bit")))
    hit = F.col("fail_bits").bitwiseAND(F.col("bit")) != 0
    return met.groupBy("policy", "rule").agg(
        F.sum(n).alias("rejected"),
        F.sum(F.when(left != 0, n).otherwise(0)).alias("without_rule"),
        F.sum(F.when(hit & (left == 0), n).otherwise(0)).alias("only_by_rule"),
        F.coalesce(F.bit_or(F.when(hit, F.col("fail_bits"))), F.lit(0)).alias("also_failed"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    failed = ~verdict("base")
    return ledger(docs).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & verdict("v1")).alias("kept"),
    )


_TAIL = " + ".join(f"case when {rule} then {BITS[name]} else 0 end" for name, rule in RULES.items())
OP3_SQL = rf"""
with t as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents
), a as (
  select rid, doc_id, text,
         regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from t
), w as (
  select rid, unnest(words) as word, generate_subscripts(words, 1) as pos from a
), g as (
  select rid, pos, word, lead(word) over d as w2, lead(word, 2) over d as w3 from w window d as (partition by rid order by pos)
), r as (
  select rid, pos, w3 is not null and count(*) over (partition by rid, word, w2, w3) > 1 as again from g
), c as (
  select rid, sum(case when again or coalesce(b1, false) or coalesce(b2, false) then 1 else 0 end) as n_repeat_words
  from (select rid, again, lag(again) over d as b1, lag(again, 2) over d as b2 from r window d as (partition by rid order by pos))
  group by rid
), m as (
  select doc_id,
         cast(len(words) as bigint) as n_words,
         cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
         cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(len(lines) as bigint) as n_lines,
         cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
         cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
         cast(length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) as bigint) as n_capitals,
         cast(length(text) - length(replace(text, '!', '')) as bigint) as n_exclamations
  from a left join c using (rid)
), b as (select *, {_TAIL} as bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (bits & {mask("base")}) <> 0 as base_failed,
       (bits & {mask("v1")}) = 0 as kept
from b
"""
