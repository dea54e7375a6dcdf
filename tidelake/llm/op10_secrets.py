"""Operator 10: secret scans through a trigram inverted index, in DataFrame functions only.

Each rule's regular expression gives a Boolean trigram query (``trigrams.query``).  The index
holds a posting (trigram, document) for every trigram that some query names; a rule's
alternatives are intersected by counting a document's postings per alternative, and a document
is a candidate when each clause has a satisfied alternative.  Candidates are joined back to
their texts and verified with the expression itself; rules without mandatory trigrams scan all
texts where they lie, without a shuffle.  A posting is keyed by document, never gathered by
trigram, so a trigram that every document has makes no hot group.

Positions are code points: the texts between matches (``split``) and the matches themselves
(``regexp_extract_all``) alternate, so running sums of their lengths are the match positions.

Defined cases: a null text is empty and has no secrets; every row gives a result row, rows
without ``doc_id`` and repeated rows included (a document is its id and text); an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.common import stored, table
from tidelake.llm.trigrams import query


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str
    group: int = 0  # the group whose length counts
    least: int = 1  # shorter ones are dropped after matching
    base: bool = False


# Runs of 16 or more hexadecimal digits and of 14 or more capitals and digits after AKIA are the
# greedy runs that reach 16 and 18 characters: a shorter run holds no longer one.
RULES = (
    Rule("assign", "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
         2, 12, True),
    Rule("access", "AKIA[A-Z0-9]{14,}", base=True),
    Rule("hex", "[0-9a-f]{16,}", base=True),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}"),
)
SPAN = "array<struct<start:int,ord:int,stop:int,kind:string>>"


def find(rule: Rule, order: int, text: Column) -> Column:
    """Spans of a rule's matches in ``text`` as an array of (start, ord, stop, kind)."""
    rx = F.lit(rule.regex)
    gaps = F.transform(F.split(text, rule.regex, -1), F.char_length)
    whole = F.transform(F.regexp_extract_all(text, rx, F.lit(0)), F.char_length)
    held = F.transform(F.regexp_extract_all(text, rx, F.lit(rule.group)), F.char_length)
    none = F.array().cast(SPAN)

    def step(acc, x):
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(order).alias("ord"), (start + x["size"]).alias("stop"),
                        F.lit(rule.kind).alias("kind"))
        kept = F.when(x["held"] >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct((start + x["size"]).alias("at"), kept.alias("out"))

    zipped = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(whole)).alias("gap"), whole.alias("size"), held.alias("held"))
    found = F.aggregate(zipped, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda a: a["out"])
    return F.when(F.regexp_like(text, rx), found).otherwise(none)


def postings(rows: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, _k, _h): the inverted index over the trigrams that the queries name."""
    low = rows.withColumn("low", F.lower("text"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select("_k", "_h", F.explode(held).alias("trigram"))


def candidates(rows: DataFrame, rules: list[tuple[int, list]]) -> DataFrame:
    """(_k, _h, rules): documents whose postings satisfy a rule's query, by intersection."""
    spark = rows.sparkSession
    needs = [(order, c, a, len(alt), t) for order, clauses in rules for c, clause in enumerate(clauses)
             for a, alt in enumerate(sorted(clause, key=sorted)) for t in sorted(alt)]
    plan = spark.createDataFrame(needs, "rule int, clause int, alt int, need int, trigram string")
    clauses = {order: len(clauses) for order, clauses in rules}
    index = postings(rows, sorted({n[-1] for n in needs}))
    # The plan's size is set by the rules alone.
    hit = (index.join(F.broadcast(plan), "trigram").groupBy("_k", "_h", "rule", "clause", "alt", "need")
           .agg(F.count_distinct("trigram").alias("n")).where("n = need"))
    met = hit.groupBy("_k", "_h", "rule").agg(F.count_distinct("clause").alias("n"))
    whole = reduce(lambda x, y: x | y, [(F.col("rule") == r) & (F.col("n") == n) for r, n in clauses.items()])
    return met.where(whole).groupBy("_k", "_h").agg(F.collect_set("rule").alias("rules"))


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id and ``found``, its spans sorted by start, then
    by the order of ``rules``."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("_k", F.coalesce("doc_id", F.lit(0))).withColumn("_h", F.xxhash64("doc_id", "text"))
    queries = [(i, query(r.regex)) for i, r in enumerate(rules)]
    indexed, full = [(i, q) for i, q in queries if q], [i for i, q in queries if not q]
    none = F.array().cast(SPAN)
    out = rows.select("doc_id", "_k", "_h", *[find(rules[i], i, F.col("text")).alias(f"s{i}") for i in full])
    if indexed:
        cand = stored(candidates(rows, indexed), "secret-candidates")
        checked = (rows.join(cand, ["_k", "_h"])
                   .select("_k", "_h", *[F.when(F.array_contains("rules", i), find(rules[i], i, F.col("text")))
                                         .otherwise(none).alias(f"s{i}") for i, _ in indexed])
                   .withColumn("any", F.concat(*[f"s{i}" for i, _ in indexed])).where(F.size("any") > 0)
                   .select("_k", "_h", "any").distinct())
        out = out.join(checked, ["_k", "_h"], "left").withColumn("any", F.coalesce("any", none))
    parts = [f"s{i}" for i in full] + ["any"] * bool(indexed)
    return out.select("doc_id", F.array_sort(F.concat(none, *parts)).alias("found"))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _count(order: int) -> Column:
    return F.size(F.filter("found", lambda s: s["ord"] == order))


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and digests of the base rules, and all spans."""
    base = [i for i, r in enumerate(rules) if r.base]
    counts = [_count(i).cast("long").alias(f"n_{rules[i].kind}") for i in base]
    of_base = F.filter("found", lambda s: s["ord"].isin(base))
    return found.select("doc_id", *counts, F.sha2(written(of_base), 256).alias("base_sha256"),
                        written(F.col("found")).alias("spans"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all ``documents``."""
    return digest(scan_secrets(table(spark, sf_dir, "documents")))


def _kind_sql(order: int, rule: Rule) -> str:
    rx = rule.regex.replace("'", "''")
    return f"""select doc_id, r, {order} as ord, '{rule.kind}' as kind, start0 as start, start0 + size as stop from (
      select doc_id, r, i, size, held, sum(gap) over w + sum(size) over w - size as start0 from (
        select doc_id, r, i, length(gaps[i]) as gap, length(whole[i]) as size, length(held[i]) as held from (
          select *, unnest(range(1, len(whole) + 1)) as i from (
            select doc_id, r, string_split_regex(text, '{rx}') as gaps, regexp_extract_all(text, '{rx}', 0) as whole,
                   regexp_extract_all(text, '{rx}', {rule.group}) as held
            from docs where regexp_matches(text, '{rx}'))))
      window w as (partition by doc_id, r order by i)) where held >= {rule.least}"""


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """The same result as DuckDB SQL."""
    kinds = " union all ".join(_kind_sql(i, r) for i, r in enumerate(rules))
    base = ", ".join(str(i) for i, r in enumerate(rules) if r.base)
    text = "string_agg(kind || ':' || cast(start as bigint) || ':' || cast(stop as bigint), ',' order by start, ord)"
    counts = ", ".join(f"cast(coalesce(n{i}, 0) as bigint) as n_{r.kind}" for i, r in enumerate(rules) if r.base)
    sums = ", ".join(f"count(*) filter (ord = {i}) as n{i}" for i, r in enumerate(rules) if r.base)
    return f"""with docs as (select doc_id, row_number() over () as r, coalesce(text, '') as text from documents),
    found as ({kinds}),
    per as (select r, {sums}, {text} filter (ord in ({base})) as base_text, {text} as all_text from found group by r)
    select doc_id, {counts}, sha256(coalesce(base_text, '')) as base_sha256, coalesce(all_text, '') as spans
    from docs left join per using (r)"""
