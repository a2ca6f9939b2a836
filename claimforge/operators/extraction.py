"""Creditors, form fields, links and events out of texts, one set operation per table."""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimforge.functions import money, names, places
from claimforge.session import materialize

# What tells kinds of documents apart, in order of precedence.
ANCHORS = {
    "form_201": (r"official\s+form\s+201", r"voluntary\s+petition", r"form\s+201"),
    "creditor_matrix": (r"list\s+of\s+creditors", r"creditor\s+matrix", r"form\s+204", r"20\s+largest\s+unsecured"),
    "schedule": (r"schedule\s+[a-f]", r"schedule\s+e\s*/\s*f", r"form\s+206"),
    "sofa": (r"statement\s+of\s+financial\s+affairs", r"\bsofa\b"),
}
# Link texts that name a list of creditors.
LINK_TEXT = r"(?i)top\s+20|b\s*104|20\s+largest|creditor\s+(list|matrix|schedule)|unsecured\s+creditors|form\s+204"
# Words of event texts.
EXCLUDED = (
    "certificate of credit counseling", "certificate of mailing", "personal financial management", "proof of claim", "meeting of creditors",
    r"\[schedules\]", "chapter 13 plan", "notice of hearing",
)
BUSINESS = ("llc", "inc", "corp", "corporation", "ltd", "lp", "holdings", "company", r"co\.", "group", "enterprises")

# Our own default words of claims schedules that a feed item may name; a deployment passes its table.
SCHEDULE_WORDS = ("schedule f", "schedule e/f", "unsecured claims", "list of creditors", "creditor matrix", "form 204", "20 largest")
# Patterns of petitions, in the order in which they are tried.
FORM_PATTERNS = {
    "debtor_name": (r"Debtor\s+1[:\s]+(.+?)(?:\n|$)", r"Name of debtor[:\s]+(.+?)(?:\n|$)", r"Debtor(?:'s)?\s+name[:\s]+(.+?)(?:\n|$)"),
    "city": (r"City[:\s]+([A-Za-z .'-]+)",),
    "state": (r"State[:\s]+([A-Z]{2})\b", r"\b([A-Z]{2})\s+\d{5}"),
    "court_district": (r"(United States Bankruptcy Court.+?District of [^\n]+)", r"(District of [^\n]+)"),
    "industry_code": (r"NAICS[:\s]+(\d{6})", r"Nature of business[:\s]+.*?(\d{6})"),
}
DOLLAR_RANGES = (r"\$\s*([\d,]+(?:\.\d+)?)\s*(?:to|-|–)\s*\$?\s*([\d,]+(?:\.\d+)?)", r"\$\s*([\d,]+(?:\.\d+)?)\s*or\s+more", r"less\s+than\s+\$?\s*([\d,]+(?:\.\d+)?)")
CREDITOR_RANGES = (r"(\d+)\s*(?:to|-|–)\s*(\d+)\s*creditors?", r"(\d+)\s*or\s+more\s*creditors?", r"less\s+than\s+(\d+)\s*creditors?")
# Patterns of feed items and of creditor lists.
CASE_NUMBER = r"(?i)(\d{2}-\d{4,6}(?:-[a-z0-9]+)*)"
COURT_HOST = r"ecf\.([a-z]+)\.uscourts\.gov"
DOCUMENT_URLS = (r"(?i)href=['\"]([^'\" ]*doc1[^'\" ]+)['\"]", r"(?i)(https://ecf\.[^' ]+/doc1/[^' ]+)")
CHAPTER = r"chapter[:\s]+(\d+)"
LINE_NUMBER = r"^(\d+)\.?\s+"
AMOUNT = r"(\$\s*[\d,]+(?:\.\d+)?)"
AMOUNT_ONLY = r"^[$\d.,\s]+$"
# Words in the first row of a table of unsecured claims.
SCHEDULE_HEADS = ("schedule e", "schedule f", "206e", "206f", "unsecured", "nature of claim", "creditors holding")
# What ends a line, and what white space is, in texts of any origin.
LINE_END = r"\r\n|[\n\r\x0B\f\x1C-\x1E\x85\u2028\u2029]"
_EDGES = r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$"


def _bare(text: Column) -> Column:
    """``text`` without white space of any kind at its ends."""
    return F.regexp_replace(text, _EDGES, "")


def _words(pattern: str) -> list[str]:
    """The words that every match of a pattern holds, longest first; the patterns are words with blanks, boundaries and classes between."""
    return sorted(re.findall(r"[a-z0-9]+", re.sub(r"\\.|\[[^]]*\]", " ", pattern)), key=len, reverse=True)


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hint_col: str | None = None) -> DataFrame:
    """The kind with the most anchors; ties go to the earlier kind, none is unknown. Null text is unknown.

    A row whose ``hint_col`` names a known kind gets that kind, with the score of its anchors.
    """
    docs = docs.select(id_col, F.lower(F.coalesce(text_col, F.lit(""))).alias("_low"), *([F.col(hint_col).alias("_hint")] if hint_col else []))
    low = F.col("_low")

    def holds(pattern: str) -> Column:  # a text that lacks a word of the pattern needs no regular expression
        return functools.reduce(lambda a, w: a & F.contains(low, F.lit(w)), _words(pattern), F.lit(True)) & low.rlike(pattern)

    scores = [
        F.struct(sum((holds(p).cast("int") for p in patterns), F.lit(0)).alias("score"), F.lit(-k).alias("rank"), F.lit(kind).alias("kind"))
        for k, (kind, patterns) in enumerate(ANCHORS.items())
    ]
    scored = F.array(*scores)
    hint = F.lower(F.trim("_hint")) if hint_col else F.lit(None).cast("string")
    hinted = F.get(F.filter(scored, lambda s: s["kind"] == hint), F.lit(0))
    if hint_col:
        best = docs.select(id_col, F.coalesce(hinted, F.array_max(scored)).alias("b"), hinted.isNotNull().alias("given"))
        return best.select(id_col, F.when((F.col("b.score") > 0) | F.col("given"), F.col("b.kind")).otherwise("unknown").alias("kind"), F.col("b.score").alias("score"))
    best = docs.select(id_col, F.array_max(scored).alias("b"))
    return best.select(id_col, F.when(F.col("b.score") > 0, F.col("b.kind")).otherwise("unknown").alias("kind"), F.col("b.score").alias("score"))


def _ends(found: dict[str, Column], number) -> tuple[Column, Column, Column]:
    """Least and most of the first pattern found, and whether one was: a range, ``or more`` without an upper end, ``less than`` without a lower."""
    low, high, more, less = (found[k] for k in ("low", "high", "more", "less"))
    ranged, open_ = low.isNotNull(), low.isNull() & more.isNotNull()
    most = F.when(ranged, number(high)).when(~open_, number(less))
    return F.when(ranged, number(low)).when(open_, number(more)), most, ranged | open_ | less.isNotNull()


def _ranges(rows: DataFrame, sections: dict[str, tuple[str, str, int, int, tuple[str, ...], object]]) -> DataFrame:
    """``rows`` with ``least_``, ``most_`` and ``met_`` of each section ``(text, label, back, ahead, patterns, number)``; its texts are columns.

    Each pattern is looked for once: a step's columns are read by the next one instead of being computed in each place that names them.
    """
    texts = list(dict.fromkeys(x[0] for x in sections.values()))
    out = rows.select("*", *(F.lower(c).alias(f"_low{c}") for c in texts))
    out = out.select("*", *(F.locate(label, F.col(f"_low{c}")).alias(f"_at_{k}") for k, (c, label, *_) in sections.items())).drop(*(f"_low{c}" for c in texts))

    def near(k: str) -> Column:
        c, _, back, ahead, *_ = sections[k]
        at, begin = F.col(f"_at_{k}"), F.greatest(F.col(f"_at_{k}") - back, F.lit(1))
        return F.coalesce(F.when(at > 0, F.substring(c, begin, at + ahead - begin)).otherwise(F.col(c)), F.lit(""))

    out = out.select("*", *(near(k).alias(f"_near_{k}") for k in sections))
    parts = {"low": (0, 1), "high": (0, 2), "more": (1, 1), "less": (2, 1)}
    found = lambda k, part: F.regexp_extract(f"_near_{k}", f"(?i){sections[k][4][parts[part][0]]}", parts[part][1])
    out = out.select("*", *(found(k, part).alias(f"_{part}_{k}") for k in sections for part in parts))
    out = out.select(*rows.columns, *(F.when(F.col(f"_{part}_{k}") != "", F.col(f"_{part}_{k}")).alias(f"_{part}_{k}") for k in sections for part in parts))
    ends = []
    for k, (*_, number) in sections.items():
        ends += [c.alias(f"{side}_{k}") for side, c in zip(("least", "most", "met"), _ends({part: F.col(f"_{part}_{k}") for part in parts}, number))]
    return out.select(*rows.columns, *ends)


def form_fields(
    docs: DataFrame, id_col: str = "filing_id", text_col: str = "text", reach: int = 800, before: int = 200, after: int = 400, tables: DataFrame | None = None,
) -> DataFrame:
    """Labelled fields of petitions; null where a field is missing, and where a range is open.

    Dollar ranges are looked for within ``reach`` characters from their label, the creditor count
    from ``before`` to ``after`` characters around the first word creditor; without a label in the whole text. A dollar range that the
    text lacks is looked for in ``tables`` (``id_col, tables``; one row a document), read row by row. Texts are read before
    they meet their tables, so only fields are joined.
    """
    dollars = lambda c: F.replace(c, F.lit(","), F.lit("")).try_cast(money.MONEY)
    money_of = lambda text, label: (text, label, 0, reach, DOLLAR_RANGES, dollars)
    rows = docs.select(id_col, F.coalesce(text_col, F.lit("")).alias("_text"))
    for k in range(max(map(len, FORM_PATTERNS.values()))):  # a field's next pattern only where those before found nothing
        of = {c: p[k] for c, p in FORM_PATTERNS.items() if k < len(p)}
        first = lambda c, p: F.regexp_extract("_text", f"(?imd){p}", 1) if k == 0 else F.when(functools.reduce(lambda a, b: a & b, (F.col(f"_{c}{j}") == "" for j in range(k))), F.regexp_extract("_text", f"(?imd){p}", 1)).otherwise("")  # noqa: B023, E731
        rows = rows.select("*", *(first(c, p).alias(f"_raw_{c}") for c, p in of.items()))
        rows = rows.select("*", *(_bare(F.col(f"_raw_{c}")).alias(f"_{c}{k}") for c in of)).drop(*(f"_raw_{c}" for c in of))
    fields = [F.coalesce(*(F.when(F.col(f"_{c}{k}") != "", F.col(f"_{c}{k}")) for k in range(len(of)))).alias(c) for c, of in FORM_PATTERNS.items()]
    rows = _ranges(rows.select(id_col, *fields, "_text"), {
        "assets": money_of("_text", "estimated assets"), "liabilities": money_of("_text", "estimated liabilities"),
        "creditors": ("_text", "creditor", before, after, CREDITOR_RANGES, lambda c: c.try_cast("int")),
    }).drop("_text", "met_creditors")
    sides = [f"{side}_{what}" for what in ("assets", "liabilities") for side in ("least", "most")]
    if tables is not None:
        cells = F.transform(F.flatten("tables"), lambda r: F.concat_ws(" ", F.transform(r, lambda c: F.coalesce(c, F.lit("")))))
        cells = tables.where(F.size(F.flatten("tables")) > 0).select(id_col, F.concat_ws("\n", cells).alias("_cells"))
        of_cells = _ranges(cells, {what: money_of("_cells", what) for what in ("assets", "liabilities")})
        rows = rows.join(of_cells.select(id_col, *(F.col(c).alias(f"_{c}") for c in sides)), id_col, "left")
        rows = rows.withColumns({c: F.when(F.col(f"met_{c.split('_')[1]}"), F.col(c)).otherwise(F.col(f"_{c}")) for c in sides})
    return rows.select(id_col, *FORM_PATTERNS, *sides, "least_creditors", "most_creditors")


def _header(line: Column) -> Column:
    return F.lower(line).rlike(f"^({'|'.join(names.JUNK_HEADS)})\\b")


def _junk(cell: Column) -> Column:
    return names.is_junk_name(cell, whole_heads=True)


def _block(first: Column, address: Column, amount: Column) -> Column:
    """A block's fields: number and name from its first line, address, amount, entity."""
    number = places.found(first, LINE_NUMBER)
    name = _bare(F.regexp_replace(first, LINE_NUMBER, ""))
    return F.struct(
        number.try_cast("int").alias("line_number"), name.alias("name"), F.nullif(address, F.lit("")).alias("address"),
        money.claim_amount(amount).alias("claim_amount"), names.entity_type(name).alias("entity_type"),
    )


def creditor_blocks(docs: DataFrame, id_col: str = "filing_id", text_col: str = "text") -> DataFrame:
    """Creditors of texts whose blocks are set apart by blank lines."""
    raw = docs.select(id_col, F.posexplode(F.split(F.coalesce(text_col, F.lit("")), r"\n{2,}")).alias("block", "raw"))
    lines = F.filter(F.transform(F.split("raw", LINE_END), _bare), lambda x: x != "")
    able = raw.withColumn("lines", lines).where((F.size("lines") > 0) & (F.length(F.get("lines", F.lit(0))) >= 3) & ~_header(F.get("lines", F.lit(0))))
    address = F.concat_ws(", ", F.slice("lines", 2, 2))
    r = _block(F.get("lines", F.lit(0)), address, F.regexp_extract("raw", AMOUNT, 1))
    rows = able.select(id_col, "block", "raw", F.size("lines").alias("n"), r.alias("r"))
    keep = F.col("r.line_number").isNotNull() | (F.col("n") >= 2) | F.contains("raw", F.lit("$"))
    return rows.where(keep & ~_junk(F.col("r.name"))).select(id_col, "block", "r.*")


def numbered_creditors(docs: DataFrame, id_col: str = "filing_id", text_col: str = "text", range_lines: int = 20_000) -> DataFrame:
    """Creditors of texts without blank lines: a block begins at each ``N. `` line. Lines before the first are left out.

    A block is the first three of its lines and its first amount, whatever its length. A text's line numbers at which blocks
    begin cut its lines to blocks, each line once, in built-in functions and without a shuffle. The lines of a document are one array;
    of a very long one the blocks are made ``range_lines`` at a time.
    """
    bare = F.filter(F.transform(F.split(F.coalesce(text_col, F.lit("")), LINE_END), _bare), lambda x: x != "")
    lines = docs.select(F.col(id_col).alias("_id"), bare.alias("lines"))
    at = F.filter(F.transform("lines", lambda x, i: F.when(x.rlike(r"^\d+\.\s+"), i)), lambda i: i.isNotNull())
    begun = lines.select("_id", "lines", at.alias("begin")).where(F.size("begin") > 0)
    end = lambda k: F.coalesce(F.get("begin", k + 1), F.size("lines"))
    cut = lambda k: F.struct((k + 1).alias("block"), F.slice("lines", F.get("begin", k) + 1, end(k) - F.get("begin", k)).alias("b"))
    parts = begun.select("_id", "lines", "begin", F.explode(F.sequence(F.lit(0), F.size("begin") - 1, F.lit(range_lines))).alias("from"))
    some = F.sequence(F.col("from"), F.least(F.col("from") + range_lines, F.size("begin")) - 1)
    blocks = parts.select("_id", F.explode(F.transform(some, cut)).alias("x")).select("_id", "x.block", "x.b")
    blocks = blocks.select("_id", "block", F.get("b", F.lit(0)).alias("line0"), F.concat_ws(", ", F.slice("b", 2, 2)).alias("address"), F.concat_ws("\n", "b").alias("text"))
    amount = F.when(F.contains("text", F.lit("$")), F.regexp_extract("text", AMOUNT, 1))
    able = blocks.where((F.length("line0") >= 3) & ~_header(F.col("line0"))).withColumn("amount", amount)
    rows = able.select(F.col("_id").alias(id_col), F.col("block").cast("int").alias("block"), _block(F.col("line0"), F.col("address"), F.col("amount")).alias("r"))
    return rows.where((F.col("r.name") != "") & ~_junk(F.col("r.name"))).select(id_col, "block", "r.*")


def _heading(t: Column) -> Column:
    return F.lower(F.concat_ws(" ", F.transform(F.get(t, F.lit(0)), lambda c: F.coalesce(c, F.lit("")))))


def _table_rows(tables: DataFrame, id_col: str, col: str, headed: Column) -> DataFrame:
    """Creditors in the rows after the first of the tables that are ``headed``; a row is counted from 1.

    The name is a row's first cell that is no label or number of a line, the address the next such cell that is no
    amount, the claim the last amount of all its cells, those before the name included.
    """
    rows = (
        tables.select(id_col, F.posexplode(col).alias("table", "t")).where(headed & (F.size("t") > 1))
        .select(id_col, "table", F.posexplode(F.slice("t", F.lit(2), F.size("t") - 1)).alias("row", "cells"))
        .withColumn("cells", F.transform("cells", lambda c: _bare(F.coalesce(c, F.lit("")))))
    )
    # What a cell is, is told once for each. The rows come from a generator, so no filter repeats it.
    is_amount = lambda c: c.rlike(AMOUNT_ONLY) & money.claim_amount(c).isNotNull()
    told = F.transform("cells", lambda c: F.struct(c.alias("c"), ((c != "") & ~_junk(c)).alias("shown"), is_amount(c).alias("amount")))
    rows = rows.select(id_col, "table", "row", F.explode(F.array(told)).alias("cells"))
    named = rows.withColumn("k", F.array_position("cells.shown", F.lit(True)).cast("int")).where("k > 0")
    name = F.element_at("cells", F.col("k"))["c"]
    addresses = F.filter(F.slice("cells", F.col("k") + 1, F.size("cells")), lambda x: x["shown"] & ~x["amount"])
    amounts = F.filter("cells", lambda x: x["amount"])
    named = named.select(
        id_col, "table", (F.col("row") + 1).alias("row"), name.alias("name"), F.get(addresses, F.lit(0))["c"].alias("address"),
        F.try_element_at(amounts, F.lit(-1))["c"].alias("_amount"),
    )
    return named.select(id_col, "table", "row", "name", "address", money.claim_amount(F.col("_amount")).alias("claim_amount"), names.entity_type(F.col("name")).alias("entity_type"))


def table_creditors(tables: DataFrame, id_col: str = "doc_id", col: str = "tables") -> DataFrame:
    """Creditors of extracted tables ``array<array<array<string>>>`` that have a creditor or name heading."""
    return _table_rows(tables, id_col, col, _heading(F.col("t")).rlike("creditor|name"))


def schedule_creditors(tables: DataFrame, id_col: str = "doc_id", col: str = "tables") -> DataFrame:
    """Creditors of tables of unsecured claims, by words of the first row, be it title or heading."""
    head = _heading(F.col("t"))
    either = functools.reduce(lambda a, w: a | F.contains(head, F.lit(w)), SCHEDULE_HEADS, F.lit(False))
    return _table_rows(tables, id_col, col, either | (F.contains(head, F.lit("creditor")) & head.rlike("claim|amount")))


def extract_creditors(docs: DataFrame, tables: DataFrame, id_col: str = "doc_id", schedules: DataFrame | None = None) -> DataFrame:
    """Per document the first source that yields rows: tables, blocks, numbered lines.

    Tables in ``schedules`` are read as tables of schedules, those in ``tables`` as lists of creditors.
    """
    shape = [id_col, "place", "name", "address", "claim_amount", "entity_type"]
    of_tables = table_creditors(tables, id_col)
    if schedules is not None:
        of_tables = of_tables.union(schedule_creditors(schedules, id_col))
    sources = [
        of_tables.withColumn("place", F.col("row")), creditor_blocks(docs, id_col).withColumn("place", F.col("block")),
        numbered_creditors(docs, id_col).withColumn("place", F.col("block")),
    ]
    out = None
    for k, rows in enumerate(sources):
        rows = rows.select(*shape).withColumn("source", F.lit(k))
        out = rows if out is None else out.union(rows)
    out = materialize(out, "found")  # texts are read once, and not again for the first source
    first = out.groupBy(id_col).agg(F.min("source").alias("source"))
    return out.join(first, [id_col, "source"], "left_semi")


def document_links(pages: DataFrame, pattern: str = LINK_TEXT) -> DataFrame:
    """The first anchor of each page whose text matches, as an absolute URL."""
    anchor = r"(?is)<a\s[^>]*href=[\"']([^\"']+)[\"'][^>]*>(.*?)</a>"
    hrefs, texts = (F.regexp_extract_all("html", F.lit(anchor), g) for g in (1, 2))
    rows = pages.select("page_id", "url", F.posexplode(F.arrays_zip(hrefs.alias("href"), texts.alias("text"))).alias("at", "a"))
    clean = F.trim(F.regexp_replace("a.text", "<[^>]+>", ""))
    hit = rows.where(clean.rlike(pattern)).groupBy("page_id").agg(F.min_by(F.struct("url", "a.href", clean.alias("text")), "at").alias("r"))
    href, origin = F.col("r.href"), F.regexp_extract("r.url", r"^(https?://[^/]+)", 1)
    folder = F.regexp_extract("r.url", r"^(https?://[^/]+/[^?#]*/|https?://[^/]+/)", 1)
    url = F.when(href.startswith("http"), href).when(href.startswith("/"), F.concat(origin, href)).otherwise(F.concat(folder, href))
    return hit.select("page_id", url.alias("document_url"), "r.text")


def _without_first(text: Column, part: Column) -> Column:
    at = F.instr(text, part)
    return F.concat(F.left(text, at - 1), F.substring(text, at + F.length(part), F.length(text)))


def feed_events(items: DataFrame, most_content: int = 32768, most_clean: int = 12000, schedule_words: tuple[str, ...] = SCHEDULE_WORDS) -> DataFrame:
    """Docket feed items: case, chapter, court, debtor, flags, signal score and whether they qualify.

    ``items`` has ``event_id, published_at`` and any of ``title, link, content, contentSnippet, description, guid, id,
    isoDate, pubDate, event_number``; of alternate spellings the first that isn't null counts. The feed's own rule reads at most
    ``most_content`` characters of the content and ``most_clean`` of its text without tags.
    """
    squeeze = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    either = lambda *cs: F.coalesce(*(F.col(f"`{c}`").cast("string") for c in cs if c in items.columns), F.lit(None).cast("string"))
    title = squeeze(F.coalesce(either("title"), F.lit("")))
    content = F.left(F.coalesce(either("content", "contentSnippet", "description"), F.lit("")), F.lit(most_content))
    clean = F.left(squeeze(F.regexp_replace(content, "<[^>]+>", " ")), F.lit(most_clean))
    base = items.select(
        "event_id", "published_at", title.alias("t"), content.alias("c"), clean.alias("x"), F.coalesce(either("link"), F.lit("")).alias("l"),
        *(c for c in ("event_number",) if c in items.columns), either("guid", "id").alias("guid"), F.left(F.coalesce(either("isoDate", "pubDate"), F.lit("")), F.lit(10)).alias("filing_date"),
    )
    base = base.withColumn("case_number", places.found(F.col("t"), CASE_NUMBER)).withColumn("guid", F.coalesce("guid", "l")).withColumn(
        "debtor", squeeze(F.when(F.col("case_number").isNotNull(), _without_first(F.col("t"), F.col("case_number"))).otherwise(F.col("t")))
    )
    business = F.lower("debtor").rlike("|".join(BUSINESS))
    has = lambda p: F.lower("x").rlike(p)
    worth = lambda hit, points: F.when(hit, points).otherwise(0)
    signal = worth(has("voluntary petition"), 40) + worth(has("petition filed"), 30) + worth(has(r"chapter\s*11"), 20) + worth(names.holds_any(F.col("x"), schedule_words), 15)
    excluded = has("|".join(EXCLUDED))
    person = F.col("debtor").rlike("^[A-Z][a-z]+ [A-Z][a-z]+") & ~business
    court = F.lower(places.found(F.lower("l"), COURT_HOST))
    qualified = (signal >= 40) & ~person & F.col("case_number").isNotNull() & F.col("guid").isNotNull() & ~excluded
    return base.select(
        "event_id", "published_at", *(c for c in ("event_number",) if c in items.columns), "case_number", F.nullif("debtor", F.lit("")).alias("debtor_name"), places.found(F.lower("x"), CHAPTER).alias("chapter"),
        court.alias("court_id"), "filing_date", F.coalesce(*(places.found(F.col("c"), p) for p in DOCUMENT_URLS)).alias("document_url"),
        F.concat_ws(":", F.coalesce(court, F.lit("")), F.coalesce("case_number", F.lit("")), F.coalesce("guid", F.lit(""))).alias("unique_key"),
        F.when(excluded, 0).otherwise(signal).alias("signal_score"), business.alias("is_business"), person.alias("is_person"), qualified.alias("is_qualified"),
    )


def company_responses(rows: DataFrame, col: str = "body") -> DataFrame:
    """Vendor bodies as JSON text, with their alternate spellings, to one row per candidate."""
    body = F.try_parse_json(col)
    data = F.coalesce(F.try_variant_get(body, "$.data", "variant"), F.try_variant_get(body, "$.results", "variant"))
    items = F.coalesce(F.try_variant_get(data, "$", "array<variant>"), F.when(data.isNotNull(), F.array(data)))
    got = rows.select("creditor_id", F.posexplode(items).alias("place", "v"))
    pick = lambda kind, *ps: F.coalesce(*(F.try_variant_get("v", p, kind) for p in ps))
    both = lambda *ks: [p for k in ks for p in (f"$.attributes.{k}", f"$.{k}")]
    return got.select(
        "creditor_id", "place", pick("string", "$.id", *both("companyId")).alias("company_id"), pick("string", *both("name", "companyName")).alias("name"),
        pick("double", *both("matchScore", "confidence", "score")).alias("confidence"), pick("double", *both("revenue", "annualRevenue")).alias("revenue"),
        pick("double", *both("employeeCount", "employees")).alias("employees"), pick("string", *both("headquarters", "headquartersState", "state")).alias("headquarters"),
    )


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """``rows`` with ``value`` as a column that is computed once for each row: as an exploded array it is put into no filter or expression that names it."""
    return rows.select(*(c for c in rows.columns if c != name), F.explode(F.array(value)).alias(name))


def contact_responses(rows: DataFrame, col: str = "body") -> DataFrame:
    """Vendor bodies of people to one row per contact with a name; no engagement is 0.

    A body that reports an error or carries a message, and one whose ``http_status`` (if rows have it) is 429, gives no rows.
    """
    text = lambda v, *ks: F.coalesce(*(F.try_variant_get(v, f"$.{k}", "string") for k in ks))
    able = rows.where("coalesce(http_status, 0) <> 429") if "http_status" in rows.columns else rows
    able = _once(able.select("creditor_id", col), "b", F.try_parse_json(col)).where(text("b", "error", "message").isNull())
    data = F.coalesce(F.try_variant_get("b", "$.data", "variant"), F.try_variant_get("b", "$.results", "variant"), F.col("b"))
    items = F.coalesce(F.try_variant_get("d", "$", "array<variant>"), F.when(F.col("d").isNotNull(), F.array("d")))
    got = able.select("creditor_id", data.alias("d")).select("creditor_id", F.posexplode(items).alias("place", "v"))
    got = _once(got, "v", F.coalesce(F.try_variant_get("v", "$.attributes", "variant"), "v"))
    both = F.concat_ws(" ", text("v", "firstName", "first_name"), text("v", "lastName", "last_name"))
    engagement = F.coalesce(*(F.try_variant_get("v", f"$.{k}", "double") for k in ("engagementScore", "contactAccuracyScore", "score")), F.lit(0.0))
    named = _once(got, "full_name", F.coalesce(text("v", "fullName", "name"), F.nullif(F.trim(both), F.lit("")), F.lit("Unknown")))
    return named.where("full_name <> 'Unknown'").select(
        "creditor_id", "place", "full_name", text("v", "jobTitle", "title", "primaryTitle").alias("title"), text("v", "email", "emailAddress").alias("email"),
        text("v", "phone", "directPhone", "mobilePhone").alias("phone"), engagement.alias("engagement"),
    )


def docket_entries(rows: DataFrame, col: str = "payload") -> DataFrame:
    """JSON payloads of arrays of objects, or of arrays of them, to one row per object; anything else is dropped."""
    outer = F.try_variant_get(F.try_parse_json(col), "$", "array<variant>")
    inner = lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v))
    got = rows.select("filing_id", F.posexplode(F.flatten(F.transform(outer, inner))).alias("place", "v")).where(F.schema_of_variant("v").startswith("OBJECT"))
    pick = lambda *ks: F.coalesce(*(F.try_variant_get("v", f"$.{k}", "string") for k in ks))
    return got.select(
        "filing_id", "place", pick("docket_number", "number", "entry_number", "docketNumber", "id").alias("docket_number"),
        F.to_date(F.try_to_timestamp(pick("filed_at", "date_filed", "date"))).alias("filed_on"),
        pick("description", "text", "title").alias("description"), pick("document_url", "url", "link", "pdf_url").alias("document_url"),
    )
