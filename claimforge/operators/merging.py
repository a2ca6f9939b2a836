"""Upserts as set operations: one batch against a stored table, both keyed.

Parquet has no update in place: a merge yields the whole new table, ``write_version``
stores it beside the old one and then adds it to a log, and ``read_version`` reads the
newest version that the log names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimforge.functions import money, names
from claimforge.operators import linking

MONEY = "decimal(15,2)"


def last_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row that came last for each key; one aggregation with map-side combine."""
    rest = [c for c in rows.columns if c not in keys]
    rank = F.struct(*order)
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_r")).select(*keys, *(F.col(f"_r.`{c}`").alias(c) for c in rest))


def upsert(store: DataFrame, batch: DataFrame, keys: list[str], policy: Mapping[str, str] | None = None) -> DataFrame:
    """``batch`` (one row a key) into ``store``; columns are the store's.

    Per column ``policy`` is ``new`` (the batch wins, nulls too; the default), ``patch`` (the batch
    wins where it has a value), ``keep`` (the store wins where it has one), ``any`` (true if either is).
    """
    policy = policy or {}
    old = store.select(*keys, F.struct(*[c for c in store.columns if c not in keys]).alias("_old"))
    new = batch.select(*keys, F.struct(*[c for c in batch.columns if c not in keys]).alias("_new"))
    joined = old.join(new, keys, "full")

    def value(c: str) -> Column:
        a, b = F.col(f"_old.`{c}`"), F.col(f"_new.`{c}`")
        how = policy.get(c, "new") if c in batch.columns else "old"
        return {
            "old": a,
            "new": F.when(F.col("_new").isNotNull(), b).otherwise(a),
            "patch": F.coalesce(b, a),
            "keep": F.coalesce(a, b),
            "any": F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False)),
        }[how].alias(c)

    return joined.select(*(F.col(c) if c in keys else value(c) for c in store.columns))


def write_version(df: DataFrame, path: str) -> str:
    """Store ``df`` as the next version under ``path`` and return its folder.

    The log gets the version only when all of it is written, so readers never see a part.
    Of two writers the one that began later is the newer; neither sees what the other adds.
    """
    import time

    began = time.time_ns()
    version = f"{path}/v{began}"
    df.write.parquet(version)
    df.sparkSession.createDataFrame([(began, version)], "began long, version string").coalesce(1).write.mode("append").parquet(f"{path}/log")
    return version


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version under ``path``."""
    newest = spark.read.schema("began long, version string").parquet(f"{path}/log").agg(F.max_by("version", "began")).first()[0]
    return spark.read.parquet(newest)


def merge_creditors(store: DataFrame, batch: DataFrame, additive: bool = True) -> DataFrame:
    """Creditor rows of many filings into the global table, by lower-case name and address.

    Blank and junk names are skipped. A key that exists, or comes again in the batch, adds
    its claim with nulls as 0; a key that comes once keeps a null claim. The first known
    original name, confidence and source filing stay. ``additive=False`` takes only the
    newest row of each key and filing, so that a repeated batch changes nothing. If both tables
    have an ``audit``, the audits of a key are merged as in ``merge_audits``.
    """
    shown = F.trim(F.coalesce("creditor_name", F.lit("")))
    able = batch.where((shown != "") & ~names.is_junk_name(shown)).withColumn("name", shown).withColumn("address", F.nullif(F.trim("address"), F.lit("")))
    key = [F.lower("name").alias("name_key"), F.lower(F.coalesce("address", F.lit(""))).alias("address_key")]
    able = able.select(*key, "*")
    if not additive:
        able = last_per_key(able, ["name_key", "address_key", "filing_id"], ["arrival"])
    audited = "audit" in store.columns and "audit" in batch.columns
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("arrival")))
    new = able.groupBy("name_key", "address_key").agg(
        F.min_by("name", "arrival").alias("name"), first("address").alias("address"),
        F.sum("claim_amount").cast(MONEY).alias("claim"), F.count("*").alias("n"), first("original_name").alias("original_name"),
        first("confidence").alias("confidence"), first("filing_id").alias("source_filing_id"),
        F.min_by(F.coalesce(F.col("entity_type") == "company", F.lit(True)), "arrival").alias("is_company"),
    )
    old = store.select(
        F.lower(F.trim("name")).alias("name_key"), F.lower(F.trim(F.coalesce("address", F.lit("")))).alias("address_key"),
        F.struct("name", "address", "claim_amount", "original_name", "confidence", "source_filing_id", "is_company").alias("o"),
        *(["audit"] if audited else []),
    )
    if audited:
        old = old.withColumnRenamed("audit", "_audit")
        new = new.join(batch_audits(able), ["name_key", "address_key"], "left")
    joined = old.join(new, ["name_key", "address_key"], "full")
    zero = F.lit(0).cast(MONEY)
    hit, came = F.col("o").isNotNull(), F.col("n").isNotNull()
    total = (
        F.when(hit & came, F.coalesce("o.claim_amount", zero) + F.coalesce("claim", zero)).when(hit, F.col("o.claim_amount"))
        .when(F.col("n") > 1, F.coalesce("claim", zero)).otherwise(F.col("claim"))
    )
    keep = lambda c: F.coalesce(F.col(f"o.{c}"), F.col(c)).alias(c)
    return joined.select(
        "name_key", "address_key", F.when(hit, F.col("o.name")).otherwise(F.col("name")).alias("name"),
        F.when(hit, F.col("o.address")).otherwise(F.col("address")).alias("address"), total.cast(MONEY).alias("claim_amount"),
        keep("original_name"), keep("confidence"), keep("source_filing_id"), keep("is_company"),
        *([merge_audits(F.col("_audit"), F.col("audit")).alias("audit")] if audited else []),
    )


def batch_audits(rows: DataFrame) -> DataFrame:
    """The audits of rows ``name_key, address_key, arrival, audit`` as one for each key that has any.

    Names and line numbers are made distinct before they are gathered. The last known group id stays; one audit alone keeps its count.
    """
    key = ["name_key", "address_key"]
    have = rows.where("audit IS NOT NULL")
    group = F.max_by("audit.dedup_group_id", F.when(F.col("audit.dedup_group_id").isNotNull(), F.col("arrival")))
    one = have.groupBy(*key).agg(F.count("*").alias("_n"), group.alias("_group"), F.max("audit.duplicate_count").alias("_count"))

    def union(field: str) -> DataFrame:
        each = have.select(*key, F.explode(f"audit.{field}").alias("x")).where("x IS NOT NULL").distinct()
        return each.groupBy(*key).agg(F.array_sort(F.collect_list("x")).alias(field))

    all_ = one.join(union("merged_names"), key, "left").join(union("source_line_numbers"), key, "left")
    names_, lines = F.coalesce("merged_names", F.array().cast("array<string>")), F.coalesce("source_line_numbers", F.array().cast("array<int>"))
    count = F.when(F.col("_n") == 1, F.col("_count")).otherwise(F.greatest(F.lit(1), F.size(names_)))
    audit = F.struct(F.col("_group").alias("dedup_group_id"), names_.alias("merged_names"), lines.alias("source_line_numbers"), count.alias("duplicate_count"))
    return all_.select(*key, audit.alias("audit"))


def merge_audits(left: Column, right: Column) -> Column:
    """Union of two audits: names and line numbers, the newer group id, at least one duplicate."""
    none, no_lines = F.array().cast("array<string>"), F.array().cast("array<int>")
    all_names = F.array_sort(F.array_union(F.coalesce(left["merged_names"], none), F.coalesce(right["merged_names"], none)))
    lines = F.array_sort(F.array_union(F.coalesce(left["source_line_numbers"], no_lines), F.coalesce(right["source_line_numbers"], no_lines)))
    both = F.struct(
        F.coalesce(right["dedup_group_id"], left["dedup_group_id"]).alias("dedup_group_id"), all_names.alias("merged_names"),
        lines.alias("source_line_numbers"), F.greatest(F.lit(1), F.size(all_names)).alias("duplicate_count"),
    )
    return F.when(left.isNull(), right).when(right.isNull(), left).otherwise(both)


def filings_from_feed(rows: DataFrame) -> DataFrame:
    """One filing per case of a feed, the last row wins."""
    return last_per_key(rows, ["case_number"], ["filed", "line_number", "part_id", "debtor"])


def upsert_docket(rows: DataFrame, most_title: int = 500) -> DataFrame:
    """Docket entries by filing and number: the later row wins, the last known path stays. Titles have at most ``most_title`` characters."""
    order = F.struct("filed_on", "document_id", "source_id")
    return rows.where(F.trim("document_number") != "").groupBy("filing_id", "document_number").agg(
        F.max_by(F.struct("description", "filed_on", "page_count"), order).alias("r"),
        F.max_by("path", F.when(F.col("path").isNotNull(), order)).alias("path"),
    ).select("filing_id", "document_number", F.left("r.description", F.lit(most_title)).alias("title"), "r.filed_on", "r.page_count", "path")


def upsert_documents(store: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """By content and parser. A stored link is never moved: rows that would are returned as rejects."""
    keys = ["content_sha256", "parser"]
    joined = store.join(batch.select(*keys, F.col("linked_filing").alias("_new"), F.lit(True).alias("_came")), keys, "full")
    clash = F.coalesce(F.col("linked_filing") != F.col("_new"), F.lit(False))
    merged = joined.select(*keys, F.coalesce("linked_filing", "_new").alias("linked_filing"))
    return merged, joined.where(clash).select(*keys, "linked_filing", F.col("_new").alias("rejected_filing"))


def replace_groups(store: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """All stored rows of a key that the batch has are replaced by the batch's."""
    return store.join(batch.select(key).distinct(), key, "left_anti").unionByName(batch.select(store.columns))


def resolve_reviews(reviews: DataFrame, resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reviews set to resolved, and the filings that have none open any more."""
    hit = resolved.select("doc_id").distinct().withColumn("_hit", F.lit(True))
    out = (
        reviews.join(hit, "doc_id", "left")
        .withColumn("status", F.when(F.col("_hit") & F.col("status").isin("pending", "in_review"), "resolved").otherwise(F.col("status"))).drop("_hit")
    )
    clear = out.groupBy("filing_id").agg(F.bool_or(F.col("status").isin("pending", "in_review")).alias("open")).where("NOT open").select("filing_id")
    return out, clear


def dedupe_store(
    creditors: DataFrame, links: DataFrame, contacts: DataFrame | None = None, accounts: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame | None, DataFrame | None]:
    """Keep the oldest creditor of each natural key and point links, contacts and accounts to it.

    Links that clash count once. Of accounts ``creditor_id, account_id, ...`` that clash the keeper's own stays, else that of
    the least creditor. Rows of creditors that the table lacks stay as they are.
    """
    key = [F.lower(F.trim("name")).alias("nk"), F.lower(F.trim(F.coalesce("address", F.lit("")))).alias("ak")]
    keyed = creditors.select("*", *key)
    keepers = keyed.groupBy("nk", "ak").agg(F.min_by("creditor_id", F.struct("created_on", "creditor_id")).alias("keeper"))
    moves = keyed.join(keepers, ["nk", "ak"]).select("creditor_id", "keeper")
    kept = creditors.join(moves.where("creditor_id = keeper").select("creditor_id"), "creditor_id", "left_semi")

    def moved(rows: DataFrame) -> DataFrame:
        return rows.join(moves, "creditor_id", "left").withColumn("keeper", F.coalesce("keeper", "creditor_id"))

    def pointed(rows: DataFrame, columns: list[str]) -> DataFrame:
        return rows.select(*(F.col("keeper").alias(c) if c == "creditor_id" else F.col(c) for c in columns))

    out = pointed(moved(links.select("filing_id", "creditor_id")), ["filing_id", "creditor_id"]).distinct()
    if contacts is not None:
        contacts = pointed(moved(contacts), contacts.columns)
    if accounts is not None:
        columns = accounts.columns
        own = Window.partitionBy("keeper", "account_id").orderBy(F.col("creditor_id") != F.col("keeper"), "creditor_id")
        accounts = pointed(moved(accounts).withColumn("_k", F.row_number().over(own)).where("_k = 1"), columns)
    return kept, out, contacts, accounts


def purge_orphan_junk(creditors: DataFrame, *uses: DataFrame) -> DataFrame:
    """Creditors without the junk names that nothing refers to."""
    junk = creditors.where(names.is_junk_name(F.col("name")) & F.col("source_filing_id").isNull()).select("creditor_id")
    for use in uses:
        junk = junk.join(use.select("creditor_id"), "creditor_id", "left_anti")
    return creditors.join(junk, "creditor_id", "left_anti")


def set_tiers(creditors: DataFrame, wanted: DataFrame, links: DataFrame) -> DataFrame:
    """Tiers 1 to 3, only for creditors that belong to the named filing."""
    able = (
        wanted.where(F.col("tier").between(1, 3)).join(linking.creditor_filing_links(creditors, links), ["creditor_id", "filing_id"], "left_semi")
        .groupBy("creditor_id").agg(F.max_by("tier", "filing_id").alias("_tier"))
    )
    return creditors.join(able, "creditor_id", "left").withColumn("company_tier", F.coalesce("_tier", "company_tier")).drop("_tier")


def set_company_ids(creditors: DataFrame, wanted: DataFrame) -> DataFrame:
    new = wanted.where(F.coalesce(F.trim("new_id"), F.lit("")) != "").groupBy("creditor_id").agg(F.max(F.trim("new_id")).alias("_id"))
    return creditors.join(new, "creditor_id", "left").withColumn("company_id", F.coalesce("_id", "company_id")).drop("_id")


def config_changes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """INSERT, UPDATE and DELETE rows between two versions of a table, with both payloads."""
    pack = lambda df, c: df.select(key, F.to_json(F.struct(*sorted(df.columns))).alias(c))
    joined = pack(old, "old_row").join(pack(new, "new_row"), key, "full").where(~F.col("old_row").eqNullSafe(F.col("new_row")))
    kind = F.when(F.col("old_row").isNull(), "INSERT").when(F.col("new_row").isNull(), "DELETE").otherwise("UPDATE")
    return joined.select(key, kind.alias("change"), "old_row", "new_row")


def write_back(creditors: DataFrame, contacts: DataFrame, results: DataFrame, floor: str = "full", errors: tuple[str, ...] = ("error", "limit")) -> tuple[DataFrame, DataFrame]:
    """Lookup results ``creditor_id, status, company_id, name, revenue, employees`` (revenue in thousands, one row a creditor).

    A status of ``errors`` is ``failed``, any but ``floor`` is ``no_match``; both write nothing. A match sets
    the company, the canonical name and the tier by size where known, and replaces the creditor's
    contacts by one row for the company. Returns creditors with their ``outcome``, and contacts.
    """
    outcome = F.when(F.col("status").isin(*errors), "failed").when(F.col("status").eqNullSafe(floor), "matched").otherwise("no_match")
    got = results.select(
        "creditor_id", outcome.alias("outcome"), F.nullif(F.trim("company_id"), F.lit("")).alias("_id"), F.nullif(F.trim("name"), F.lit("")).alias("_name"),
        money.tier_by_constants(F.col("revenue"), F.col("employees")).alias("_tier"),
    )
    hit = F.col("outcome") == "matched"
    new = {"company_id": "_id", "company_tier": "_tier"}
    out = creditors.join(got, "creditor_id", "left").select(
        *(F.when(hit, F.coalesce(new[c], c)).otherwise(F.col(c)).alias(c) if c in new else c for c in creditors.columns),
        F.when(hit, F.col("_name")).alias("canonical_name"), "outcome",
    )
    rows = got.where(hit).select("creditor_id", F.col("_id").alias("company_id"), F.col("_name").alias("full_name"), F.lit("company").alias("kind"))
    return out, replace_groups(contacts, rows, "creditor_id")


def apply_enrichment(creditors: DataFrame, results: DataFrame, least_score: float = 0.7) -> DataFrame:
    """Scored results per creditor: an error fails, a low score is no match and writes nothing, a match sets the company."""
    outcome = F.when(F.col("error").isNotNull(), "failed").when(F.coalesce("score", F.lit(0.0)) < least_score, "no_match").otherwise("matched")
    one = results.withColumn("outcome", outcome).groupBy("creditor_id").agg(
        F.max_by(F.struct("outcome", "new_id"), F.struct("score", "new_id")).alias("r")
    )
    hit = F.col("r.outcome") == "matched"
    return creditors.join(one, "creditor_id", "left").select(
        "creditor_id", F.when(hit, F.col("r.new_id")).otherwise(F.col("company_id")).alias("company_id"), F.col("r.outcome").alias("outcome")
    )


def add_results(old: DataFrame, new: DataFrame, keys: list[str], field: str) -> DataFrame:
    """Maps of results by key; the newer map wins entry by entry."""
    joined = old.select(*keys, F.col(field).alias("_a")).join(new.select(*keys, F.col(field).alias("_b")), keys, "full")
    none = F.create_map().cast("map<string,string>")
    a, b = F.coalesce("_a", none), F.coalesce("_b", none)
    kept = F.map_filter(a, lambda k, _: ~F.array_contains(F.map_keys(b), k))
    return joined.select(*keys, F.map_concat(kept, b).alias(field))
