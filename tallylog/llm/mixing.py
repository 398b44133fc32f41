"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations only.

A tree root - domain - language - source holds the tokens of the documents at
its leaves. A token budget flows down: at each node it is dealt to the children
by weight, a child takes at most what its subtree can give (its tokens times
``max_epochs``), and what it cannot take goes to its siblings by weight. As a
node never gets more than its subtree can give, a shortage leaves a family only
when all siblings are full.

A leaf reads its documents epoch after epoch, each epoch in an order of its own
(the hash of seed, epoch and doc_id), and selects the longest prefix that stays
within its tokens. The prefix is found by counting: tokens of each leaf by hash
prefix, then the one hash range that holds the end. No leaf is sorted as a whole
and no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallylog.llm.common import stage, table

LEAF = ["domain", "lang", "source"]
#: Documents of a hash range, about: what one task sorts to find where a leaf's prefix ends.
RANGE_ROWS = 4096

#: Production weights; a name that is not listed weighs 1.
WEIGHTS = {"domain": {"web": 3, "books": 2}, "lang": {"en": 4, "fr": 2, "de": 2}, "source": {"src0": 2}}
SEED = 20


def domain_of(source: Column) -> Column:
    """The domain of a source, by the number at its end modulo 3; ``other`` without one."""
    kind = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]{1,9})$", 1)
    n = F.when(kind == "", None).otherwise(kind).cast("int") % 3
    return (F.when(n == 0, "web").when(n == 1, "books").when(n == 2, "forums").otherwise("other"))


def token_count(text: Column) -> Column:
    """Words: runs of anything but ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def _order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"),
                          F.coalesce(doc_id.cast("string"), F.lit(""))))


def _weight(column: str, weights: dict[str, int]) -> Column:
    out = F.lit(1)
    for name, w in weights.items():
        out = F.when(F.col(column) == name, F.lit(int(w))).otherwise(out)
    return out.cast("decimal(38,0)")


def _fill(children: DataFrame, parents: list[str], child: str) -> DataFrame:
    """Deal ``given`` of each parent to its children by weight ``w`` up to ``cap``; adds ``got``.

    With the children in order of cap / w, those below the water level are a
    prefix: a child is full if its cap fits the share that it has once all before it
    are full. The rest share what is left. Whole tokens; a remainder of less than
    one token a child is not dealt.
    """
    w = Window.partitionBy(*parents).orderBy((F.col("cap") / F.col("w")).cast("double"), child)
    before = F.coalesce(F.sum("cap").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("w").over(w.rowsBetween(0, Window.unboundedFollowing))
    dec = "decimal(38,0)"
    x = (children.withColumn("left", (F.col("given") - before).cast("decimal(20,0)"))
         .withColumn("rest", rest.cast("decimal(9,0)")).withColumn("place", F.row_number().over(w)))
    full = F.col("cap").cast("decimal(20,0)") * F.col("rest") <= F.col("left") * F.col("w").cast("decimal(9,0)")
    x = x.withColumn("full", full)
    first = F.min(F.when(~F.col("full"), F.struct("place", "left", "rest"))).over(Window.partitionBy(*parents))
    x = x.withColumn("open", first)
    share = F.expr("(open.left * cast(w as decimal(9,0))) div open.rest").cast(dec)
    return (x.withColumn("got", F.when(F.col("full"), F.col("cap")).otherwise(share).cast(dec))
            .drop("left", "rest", "place", "full", "open"))


def leaf_budgets(counts: DataFrame, weights: dict[str, dict[str, int]], share: float, max_epochs: int) -> DataFrame:
    """Budgets of the leaves: domain, lang, source, supply, budget, whole_epochs, rest (tokens of the last epoch).

    ``counts``: domain, lang, source, supply. The whole budget is ``share`` of all tokens.
    """
    dec = "decimal(38,0)"
    leaves = counts.withColumn("cap", (F.col("supply") * max_epochs).cast(dec))
    langs = leaves.groupBy("domain", "lang").agg(F.sum("cap").cast(dec).alias("cap"))
    domains = (leaves.groupBy("domain").agg(F.sum("cap").cast(dec).alias("cap"), F.sum("supply").alias("tokens"))
               .withColumn("root", F.lit(0)).withColumn("w", _weight("domain", weights["domain"])))
    whole_corpus = F.sum("tokens").over(Window.partitionBy("root")).cast("decimal(30,0)")
    domains = domains.withColumn("given", F.call_function("div", whole_corpus * F.lit(int(share * 1000)), F.lit(1000)).cast(dec))
    domains = _fill(domains, ["root"], "domain")
    langs = langs.join(domains.select("domain", F.col("got").alias("given")), "domain")
    langs = _fill(langs.withColumn("w", _weight("lang", weights["lang"])), ["domain"], "lang")
    leaves = leaves.join(langs.select("domain", "lang", F.col("got").alias("given")), ["domain", "lang"])
    leaves = _fill(leaves.withColumn("w", _weight("source", weights["source"])), ["domain", "lang"], "source")
    whole = F.expr("CASE WHEN supply > 0 THEN cast(got div supply AS bigint) ELSE 0L END")
    return leaves.select(*LEAF, "supply", F.col("got").cast("bigint").alias("budget"), whole.alias("whole_epochs"),
                         (F.col("got").cast("bigint") - whole * F.col("supply")).alias("rest"))


def range_digits(rows: int, size: int | None = None) -> int:
    """Hex digits of the order key that make a hash range: with any number of rows, and all of them in one leaf, a
    range holds about ``size`` of them."""
    digits = 1
    while 16**digits * (size or RANGE_ROWS) < rows:
        digits += 1
    return digits


def plan_mix(docs: DataFrame, weights: dict[str, dict[str, int]], share: float, max_epochs: int, seed: int) -> DataFrame:
    """The mix as one row a leaf: the budgets and ``cutoff``, the largest order key taken from the last epoch.

    ``docs``: domain, lang, source, doc_id, tokens.
    """
    docs = stage(docs, "mix-tokens")
    digits = range_digits(docs.count())
    counts = docs.groupBy(*LEAF).agg(F.sum("tokens").alias("supply"))
    leaves = stage(leaf_budgets(counts, weights, share, max_epochs), "mix-leaves")
    keyed = (docs.join(leaves.filter("rest > 0"), LEAF)
             .withColumn("key", _order_key(seed, F.col("whole_epochs"), F.col("doc_id")))
             .withColumn("range", F.substring("key", 1, digits)))
    by_range = keyed.groupBy(*LEAF, "range").agg(F.sum("tokens").alias("n"), F.first("rest").alias("rest"))
    w = Window.partitionBy(*LEAF).orderBy("range")
    ends = (by_range.withColumn("upto", F.sum("n").over(w))
            .filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("n") <= F.col("rest")))
            .select(*LEAF, "range", (F.col("rest") - F.col("upto") + F.col("n")).alias("room")))
    ends = stage(ends, "mix-ends")
    near = keyed.join(ends, [*LEAF, "range"]).groupBy(*LEAF, "range", "key", "room").agg(F.sum("tokens").alias("n"))
    taken = (near.withColumn("upto", F.sum("n").over(Window.partitionBy(*LEAF).orderBy("key")))
             .filter("upto <= room").groupBy(*LEAF).agg(F.max("key").alias("last")))
    ends = ends.join(taken, LEAF, "left").select(*LEAF, F.coalesce("last", "range").alias("cutoff"))
    return stage(leaves.join(ends, LEAF, "left"), "mix-plan")


def mix(docs: DataFrame, weights: dict[str, dict[str, int]] = WEIGHTS, share: float = 0.5, max_epochs: int = 2,
        seed: int = SEED) -> DataFrame:
    """Select documents so that domains, languages and sources come near their weights.

    ``docs`` has doc_id, text, lang and source. Returns its columns with ``domain``,
    ``tokens``, ``epoch`` (from 0; a document may come once an epoch) and ``order_key``;
    columns of these names in ``docs`` are replaced. A null lang or source makes a
    leaf of its own, shown as ''. A null text has no tokens. Rows that share a
    doc_id have one order key and are taken or left together, with all their tokens;
    a null doc_id counts as ''. A leaf without tokens gives nothing; documents
    without tokens come with the prefix that they stand in. An empty table gives no rows.
    Texts, however long, are counted whole where they are. Other columns, of any name, are kept.
    """
    added = ("domain", "tokens", "epoch", "order_key")
    kept = [c for c in docs.columns if c not in added]
    leaf = [domain_of(F.col("source")).alias("domain"), F.coalesce("lang", F.lit("")).alias("lang"),
            F.coalesce("source", F.lit("")).alias("source")]
    tokens = token_count(F.col("text")).alias("tokens")
    plan = plan_mix(docs.select(*leaf, "doc_id", tokens), weights, share, max_epochs, seed)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), *leaf, "doc_id", tokens)
    # epochs that some document may be in: those read whole, and the one read in part
    epochs = F.when(F.col("whole_epochs") + (F.col("rest") > 0).cast("int") > 0,
                    F.sequence(F.lit(0).cast("bigint"), F.col("whole_epochs") + (F.col("rest") > 0).cast("int") - 1))
    return (rows.join(plan, LEAF).withColumn("epoch", F.explode(epochs))
            .withColumn("order_key", _order_key(seed, F.col("epoch"), F.col("doc_id")))
            .filter((F.col("epoch") < F.col("whole_epochs")) | (F.col("order_key") <= F.col("cutoff")))
            .select("row.*", F.col("domain"), "tokens", F.col("epoch").cast("int").alias("epoch"), "order_key"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production mix of all ``documents``: half of all tokens, at most two epochs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mix(docs).select("doc_id", "domain", F.coalesce("lang", F.lit("")).alias("lang"),
                            F.coalesce("source", F.lit("")).alias("source"), "epoch", "tokens", "order_key")


def _weight_sql(column: str) -> str:
    whens = " ".join(f"WHEN {column} = '{name}' THEN {w}" for name, w in WEIGHTS[column].items())
    return f"CASE {whens} ELSE 1 END"


def _fill_sql(name: str, source: str, parents: str, child: str) -> str:
    order = f"PARTITION BY {parents} ORDER BY cap / w, {child}"
    return f"""
{name}_w AS (SELECT *, given - coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
    sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rst, row_number() OVER ({order}) AS place
  FROM ({source})),
{name}_f AS (SELECT *, cap * rst <= lft * w AS isfull FROM {name}_w),
{name}_o AS (SELECT *, min(CASE WHEN NOT isfull THEN place END) OVER (PARTITION BY {parents}) AS at FROM {name}_f),
{name} AS (SELECT a.*, CAST(CASE WHEN a.isfull THEN a.cap ELSE (b.lft * a.w) // b.rst END AS HUGEINT) AS got
  FROM {name}_o a LEFT JOIN {name}_o b ON b.place = a.at AND {' AND '.join(f'a.{p.strip()} = b.{p.strip()}' for p in parents.split(','))}),"""


ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CASE CAST(nullif(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1), '') AS INTEGER) % 3
      WHEN 0 THEN 'web' WHEN 1 THEN 'books' WHEN 2 THEN 'forums' ELSE 'other' END AS domain,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens
  FROM documents),
leaf AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS supply, CAST(sum(tokens) * 2 AS HUGEINT) AS cap FROM d GROUP BY ALL),
{_fill_sql('dom', f"SELECT 0 AS root, domain, CAST(sum(cap) AS HUGEINT) AS cap, {_weight_sql('domain')} AS w, (SELECT CAST(sum(supply) * 500 // 1000 AS HUGEINT) FROM leaf) AS given FROM leaf GROUP BY domain", 'root', 'domain')}
{_fill_sql('lng', f"SELECT l.domain, l.lang, l.cap, {_weight_sql('lang')} AS w, dom.got AS given FROM (SELECT domain, lang, CAST(sum(cap) AS HUGEINT) AS cap FROM leaf GROUP BY ALL) l JOIN dom USING (domain)", 'domain', 'lang')}
{_fill_sql('src', f"SELECT leaf.domain, leaf.lang, leaf.source, leaf.supply, leaf.cap, {_weight_sql('source')} AS w, lng.got AS given FROM leaf JOIN lng USING (domain, lang)", 'domain, lang', 'source')}
plan AS (SELECT domain, lang, source, CASE WHEN supply > 0 THEN got // supply ELSE 0 END AS whole,
    CASE WHEN supply > 0 THEN got % supply ELSE 0 END AS rest FROM src),
rows_ AS (SELECT d.*, p.whole, p.rest, unnest(range(0, CAST(p.whole + CASE WHEN p.rest > 0 THEN 1 ELSE 0 END AS BIGINT))) AS epoch
  FROM d JOIN plan p USING (domain, lang, source)),
keyed AS (SELECT *, md5('{SEED}:' || epoch || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS order_key FROM rows_),
summed AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source, epoch ORDER BY order_key) AS upto FROM keyed)
SELECT doc_id, domain, lang, source, CAST(epoch AS INTEGER) AS epoch, tokens, order_key FROM summed
WHERE epoch < whole OR upto <= rest"""
