"""Mixing sources to target weights, with DataFrame operations only.

Weights go down a tree of domain, language and source. Each node deals its budget out among its children by weight; a child
takes no more than its own leaves can give, and what it can't take goes to its siblings before anything returns to the level
above. A leaf gives its documents once per full epoch and then a prefix, in tokens, of one more epoch in a seeded order.
What prefixes leave over, as documents aren't cut, goes round once more in the same way: among the leaves of one language,
then those of its domain, then all, smaller documents first, each leaf gets its next document as long as the rest lasts.
All arithmetic is in whole numbers, so results don't depend on the engine or the order of rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, numbered, place_of, without

#: Leaves are sent to all tasks up to this many; beyond it they are joined by key.
BROADCAST_LEAVES = 100_000
#: Hexadecimal digits of the order key that make a bucket: prefix sums run over bucket sums, and over documents in one bucket of each leaf only.
BUCKET_DIGITS = 3


@dataclass(frozen=True)
class Mixture:
    """domains: regular expression of source names by domain (the first in order that matches). Weights are whole numbers.

    budget_permille: tokens to give, in thousandths of all tokens. max_epochs: how often a document may be given.
    """

    domains: Mapping[str, str] = field(default_factory=dict)
    domain_weights: Mapping[str, int] = field(default_factory=dict)
    language_weights: Mapping[str, int] = field(default_factory=dict)
    source_weights: Mapping[str, int] = field(default_factory=dict)
    default_weight: int = 10
    budget_permille: int = 1000
    max_epochs: int = 4
    seed: int = 17


#: The production mixture.
PRODUCTION = Mixture(
    domains={"web": "^src[0-9]$", "books": "^src1[0-4]$", "reference": "^src1[5-9]$"},
    domain_weights={"web": 50, "books": 30, "reference": 20},
    language_weights={"en": 60, "de": 15, "fr": 15, "es": 10},
)


def _case(column: Column, table: Mapping[str, int], default) -> Column:
    out = F.lit(default)
    for key, value in reversed(table.items()):
        out = F.when(column == F.lit(key), F.lit(value)).otherwise(out)
    return out


def _deal(children: DataFrame, parents: DataFrame | None, keys: list[str], total: Column | None) -> DataFrame:
    """Give each child its share of its parent's budget: by weight, and up to its capacity.

    Children are looked at by capacity against weight: as long as one's share is its capacity or more it is filled, and the
    rest is dealt out among those behind it. children: keys, child, weight, capacity, and their parent's budget by keys.
    """
    if parents is None:
        children = children.withColumn("given", total)
    else:
        children = children.join(parents, keys)
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    ordered = group.orderBy(F.col("capacity") / F.col("weight"), "child")
    before = F.coalesce(F.sum("capacity").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    behind = F.sum("weight").over(ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    left = F.col("given") - F.col("before")
    full = left.cast("decimal(38,0)") * F.col("weight") >= F.col("capacity").cast("decimal(38,0)") * F.col("behind")
    children = children.withColumn("before", before).withColumn("behind", behind).withColumn("full", full)
    # the first that isn't full fixes the rate for all behind it
    first = F.min(F.when(~F.col("full"), F.struct("before", (-F.col("behind")).alias("minus")))).over(group)
    children = children.withColumn("first", first)
    share = F.when(F.col("full"), F.col("capacity")).otherwise(
        F.expr("cast(given - first.before as decimal(38,0)) * weight div (-first.minus)")
    )
    return children.withColumn("budget", F.least(share.cast("long"), F.col("capacity"))).drop("before", "behind", "full", "first", "given")


def leaf_budgets(docs: DataFrame, mixture: Mixture) -> DataFrame:
    """(domain, mix_lang, mix_source, tokens, budget) for each leaf that has tokens. docs: domain, mix_lang, mix_source, n_tokens."""
    leaves = docs.groupBy("domain", "mix_lang", "mix_source").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0")
    leaves = leaves.withColumn("capacity", F.col("tokens") * mixture.max_epochs)
    languages = leaves.groupBy("domain", "mix_lang").agg(F.sum("capacity").alias("capacity"))
    domains = languages.groupBy("domain").agg(F.sum("capacity").alias("capacity"))
    all_tokens = F.expr(f"sum(capacity) over (partition by 0) div {mixture.max_epochs} * {mixture.budget_permille} div 1000")
    capacity_of_all = F.sum("capacity").over(Window.partitionBy(F.lit(0)))
    domains = domains.select("domain", F.col("domain").alias("child"), "capacity", _case(F.col("domain"), mixture.domain_weights, mixture.default_weight).cast("long").alias("weight"))
    domains = _deal(domains, None, [], F.least(all_tokens, capacity_of_all))
    languages = languages.select("domain", "mix_lang", F.col("mix_lang").alias("child"), "capacity", _case(F.col("mix_lang"), mixture.language_weights, mixture.default_weight).cast("long").alias("weight"))
    languages = _deal(languages, domains.select("domain", F.col("budget").alias("given")), ["domain"], None)
    leaves = leaves.withColumn("child", F.col("mix_source")).withColumn("weight", _case(F.col("mix_source"), mixture.source_weights, mixture.default_weight).cast("long"))
    leaves = _deal(leaves, languages.select("domain", "mix_lang", F.col("budget").alias("given")), ["domain", "mix_lang"], None)
    return leaves.select("domain", "mix_lang", "mix_source", "tokens", "budget")


def _grant(leaves: DataFrame) -> DataFrame:
    """(domain, mix_lang, mix_source) of the leaves that get their next document. leaves: those, room (tokens left over) and need (of the next document).

    At each level, from siblings upwards, the rest of all leaves below a node goes to their next documents in order of size.
    """
    keys = ["domain", "mix_lang", "mix_source"]
    leaves = leaves.withColumn("granted", F.lit(False))
    for level in (keys[:2], keys[:1], []):
        group = Window.partitionBy(*level) if level else Window.partitionBy(F.lit(0))
        rest = F.sum(F.col("room") - F.when(F.col("granted"), F.col("need")).otherwise(0)).over(group)
        so_far = F.sum("need").over(Window.partitionBy(*(level or [F.lit(0)]), "granted").orderBy("need", *keys).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        leaves = leaves.withColumns({"rest": rest, "so_far": so_far}).withColumn("granted", F.col("granted") | (F.col("so_far") <= F.col("rest"))).drop("rest", "so_far")
    return leaves.where("granted").select(*keys)


def _mixed(docs: DataFrame, mixture: Mixture) -> DataFrame:
    """numbered(docs) with domain, n_tokens and epoch."""
    keys = ["domain", "mix_lang", "mix_source"]
    plain = numbered(docs)
    id_, text, lang, source = (F.col(place_of(docs, n)) for n in ("doc_id", "text", "lang", "source"))
    domain: Column = F.lit("other")
    for name, pattern in reversed(mixture.domains.items()):
        domain = F.when(F.coalesce(source, F.lit("")).rlike(pattern), F.lit(name)).otherwise(domain)
    words = F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    counted = plain.select(*plain.columns, id_.alias("doc_id"), domain.alias("domain"), F.coalesce(lang, F.lit("")).alias("mix_lang"), F.coalesce(source, F.lit("")).alias("mix_source"), words.alias("n_tokens"))

    plan = leaf_budgets(counted, mixture)
    plan = plan.select(*keys, F.expr("budget div tokens").alias("mix_full"), F.expr("budget % tokens").alias("mix_rest"))
    plan = materialize(plan, "mix-plan")
    small = plan.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES
    send = F.broadcast if small else (lambda df: df)

    def order_key(epoch: Column) -> Column:
        return F.md5(F.concat_ws("-", F.lit(str(mixture.seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))

    # where the prefix of the last epoch ends: sums by bucket of the order key, then documents of one bucket of each leaf
    narrow = counted.select(*keys, "doc_id", "n_tokens").join(send(plan.where("mix_rest > 0")), keys)
    narrow = narrow.withColumn("mix_key", order_key(F.col("mix_full"))).withColumn("mix_bucket", F.substring("mix_key", 1, BUCKET_DIGITS))
    buckets = narrow.groupBy(*keys, "mix_rest", "mix_bucket").agg(F.sum("n_tokens").alias("inside"))
    running = Window.partitionBy(*keys).orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = buckets.withColumn("through", F.sum("inside").over(running))
    edge = buckets.where("through > mix_rest and through - inside <= mix_rest").select(*keys, F.col("mix_bucket").alias("mix_edge"), (F.col("mix_rest") - F.col("through") + F.col("inside")).alias("mix_room"))
    inside = narrow.join(send(edge), keys).where("mix_bucket = mix_edge")
    together = inside.groupBy(*keys, "mix_room", "mix_edge", "mix_key", "doc_id").agg(F.sum("n_tokens").alias("n_tokens"))
    in_order = Window.partitionBy(*keys).orderBy("mix_key", F.col("doc_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = F.struct("mix_key", F.coalesce("doc_id", F.lit(-(1 << 62))).alias("id"))
    last = together.withColumn("through", F.sum("n_tokens").over(in_order)).withColumn("place", place)
    # the document behind the prefix always holds tokens, so it is the first place at which the sum is too large
    last = last.groupBy(*keys, "mix_room").agg(
        F.max(F.when(F.col("through") <= F.col("mix_room"), F.col("place"))).alias("fits"),
        F.min(F.when(F.col("through") > F.col("mix_room"), F.col("place"))).alias("next"),
        F.max(F.when(F.col("through") <= F.col("mix_room"), F.col("through"))).alias("used"),
        F.min(F.when(F.col("through") > F.col("mix_room"), F.col("through"))).alias("beyond"),
    )
    last = last.withColumn("used", F.coalesce("used", F.lit(0)))
    last = materialize(last.select(*keys, "fits", "next", (F.col("mix_room") - F.col("used")).alias("room"), (F.col("beyond") - F.col("used")).alias("need")), "mix-last")
    granted = _grant(last.select(*keys, "room", "need")).withColumn("more", F.lit(True))
    last = last.join(send(granted), keys, "left").select(*keys, F.when(F.col("more"), F.col("next")).otherwise(F.col("fits")).alias("mix_last"))
    # every leaf with a rest, its edge bucket, and the last document of it that is given
    cut = materialize(plan.join(edge.select(*keys, "mix_edge"), keys, "left").join(last, keys, "left"), "mix-cut")

    given = counted.join(send(cut), keys)
    key = order_key(F.col("mix_full"))
    bucket = F.substring(key, 1, BUCKET_DIGITS)
    here = F.struct(key.alias("mix_key"), F.coalesce(F.col("doc_id"), F.lit(-(1 << 62))).alias("id"))
    more = (F.col("mix_rest") > 0) & (F.col("mix_edge").isNull() | (bucket < F.col("mix_edge")) | ((bucket == F.col("mix_edge")) & F.coalesce(here <= F.col("mix_last"), F.lit(False))))
    times = F.col("mix_full") + more.cast("long")
    given = given.withColumn("mix_times", times).where("mix_times > 0")
    return given.select(*plain.columns, "domain", "n_tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mix_times") - 1)).alias("epoch"))


def mix(docs: DataFrame, mixture: Mixture = PRODUCTION) -> DataFrame:
    """The documents that the mixture gives: all columns of docs, and domain, n_tokens and epoch; a row for each time a document is given.

    Tokens are words between white space. A null source or language is the key ""; sources of no domain are in the domain
    "other". Null or empty texts have no tokens and come with each full epoch of their leaf. Within an epoch documents go by
    the MD5 of seed, epoch and doc_id, ties by doc_id; rows that are alike in both come together or not at all. An empty
    table gives an empty table. Columns of the input named domain, n_tokens or epoch, in whatever letters, are replaced.

    The tokens given are at most the budget, and short of it by less than the smallest next document among the leaves that
    got none in the second round (each gets one at most), and what whole-number shares cut off.
    """
    docs = docs.select(*without(docs, "domain", "n_tokens", "epoch"))
    return _mixed(docs, mixture).toDF(*docs.columns, "domain", "n_tokens", "epoch")


def mix_only(docs: DataFrame, mixture: Mixture = PRODUCTION) -> DataFrame:
    """The rows of mix() with all columns of docs as they were, whatever their names, and nothing else."""
    return _mixed(docs, mixture).drop("domain", "n_tokens", "epoch").toDF(*docs.columns)


def oracle(mixture: Mixture = PRODUCTION, documents: str = "documents") -> str:
    """DuckDB SQL for doc_id, domain, n_tokens and epoch of mix()."""

    def case(column: str, table: Mapping[str, int], default: int) -> str:
        return "case " + " ".join(f"when {column} = '{k}' then {v}" for k, v in table.items()) + f" else {default} end" if table else str(default)

    domain = "case " + " ".join(f"when regexp_matches(coalesce(source, ''), '{p}') then '{n}'" for n, p in mixture.domains.items()) + " else 'other' end" if mixture.domains else "'other'"

    def deal(source: str, keys: str, child: str) -> str:
        part = f"partition by {keys}" if keys else ""
        group = ", " + keys if keys else ""
        return f"""
        select *, least(case when is_full then capacity else (given - first_before) * weight // first_behind end, capacity)::bigint as budget from (
          select *, first_value(before) over f as first_before, first_value(behind) over f as first_behind from (
            select *, (given - before)::hugeint * weight >= capacity::hugeint * behind as is_full from (
              select *, coalesce(sum(capacity) over (o rows between unbounded preceding and 1 preceding), 0)::hugeint as before,
                     (sum(weight) over (o rows between current row and unbounded following))::hugeint as behind
              from {source} window o as ({part} order by capacity / weight, {child})))
          window f as ({part} order by is_full, before, behind desc rows between unbounded preceding and unbounded following))"""

    def grant(source: str, keys: str) -> str:
        part, more = (f"partition by {keys}", f"partition by {keys}, granted") if keys else ("", "partition by granted")
        return f"""
        select domain, mix_lang, mix_source, room, beyond, need, granted or so_far <= left_over as granted from (
          select *, sum(room - case when granted then need else 0 end) over ({part}) as left_over,
                 sum(need) over ({more} order by need, domain, mix_lang, mix_source rows between unbounded preceding and current row) as so_far
          from {source})"""

    return f"""
    with d as (
      select doc_id, {domain} as domain, coalesce(lang, '') as mix_lang, coalesce(source, '') as mix_source,
             coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as n_tokens from {documents}),
    l0 as (select domain, mix_lang, mix_source, sum(n_tokens)::bigint as tokens, sum(n_tokens)::bigint * {mixture.max_epochs} as capacity from d group by all having sum(n_tokens) > 0),
    g0 as (select domain, mix_lang, sum(capacity)::bigint as capacity from l0 group by all),
    d0 as (select domain, sum(capacity)::bigint as capacity, {case("domain", mixture.domain_weights, mixture.default_weight)}::bigint as weight from g0 group by domain),
    d1 as (select *, (select least(sum(capacity) // {mixture.max_epochs} * {mixture.budget_permille} // 1000, sum(capacity))::bigint from d0) as given from d0),
    d2 as ({deal("d1", "", "domain")}),
    g1 as (select g0.*, {case("mix_lang", mixture.language_weights, mixture.default_weight)}::bigint as weight, d2.budget as given from g0 join d2 using (domain)),
    g2 as ({deal("g1", "domain", "mix_lang")}),
    l1 as (select l0.*, {case("mix_source", mixture.source_weights, mixture.default_weight)}::bigint as weight, g2.budget as given from l0 join g2 using (domain, mix_lang)),
    l2 as ({deal("l1", "domain, mix_lang", "mix_source")}),
    p as (select domain, mix_lang, mix_source, budget // tokens as full_epochs, budget % tokens as rest from l2),
    k as (select d.*, full_epochs, rest, md5('{mixture.seed}-' || full_epochs::varchar || '-' || coalesce(doc_id::varchar, '')) as key from d join p using (domain, mix_lang, mix_source)),
    r as (select *, sum(n_tokens) over (partition by domain, mix_lang, mix_source order by key, doc_id nulls first range between unbounded preceding and current row) as through from k),
    n0 as (select domain, mix_lang, mix_source, max(rest) - coalesce(max(through) filter (where through <= rest), 0) as room, min(through) filter (where through > rest) as beyond,
                  min(through) filter (where through > rest) - coalesce(max(through) filter (where through <= rest), 0) as need
           from r where rest > 0 group by all),
    n1 as ({grant("(select *, false as granted from n0)", "domain, mix_lang")}),
    n2 as ({grant("n1", "domain")}),
    n3 as ({grant("n2", "")}),
    g as (select r.*, beyond, coalesce(granted, false) as granted, sum(n_tokens) over (partition by domain, mix_lang, mix_source, key, doc_id) as alike from r left join n3 using (domain, mix_lang, mix_source))
    select doc_id, domain, n_tokens, unnest(range(0, (full_epochs + (case when rest > 0 and (through <= rest or granted and through = beyond and alike > 0) then 1 else 0 end))::bigint))::bigint as epoch from g"""
