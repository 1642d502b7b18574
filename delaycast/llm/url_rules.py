"""URL filter: listed rules first, then association rules mined by FP-growth.

A URL's host and path are matched with listed rules of a host and a path: a rule fits its host and
all subdomains if the path starts with the rule's, and the longest fitting rule decides. For all other
URLs the verdict comes from combinations of URL tokens (scheme, domain parts, path segments, arguments,
with numbers replaced). FP-growth mines them, together with the label, from the URLs that no listed rule
decides and whose page has a label (1 allows, 0 blocks). Rules that imply a verdict are pruned by support
and confidence, and dropped if the rule without one of their tokens implies the same as surely. Support
is a number of URLs, not a share, so that a host counts alike in a table of any size; combinations in
fewer labelled URLs than that stay unmined, and URLs with no others are allowed.

Tokens that occur in the very same labelled URLs tell nothing apart, so they are mined as one item: a
URL shape with many arguments is a single item and not all their combinations. An item is in a URL if
any of its tokens is, which is what rules of every choice of one token an item would match.

Rules match by an inverted index: each is filed under its rarest item, and looked up by the items of a
URL's token set. URLs with equal token sets are looked up once, however many there are. Of the matching
rules the one with the highest confidence decides, then support, then the one of fewer items, then one
that blocks. A URL that none matches is allowed.

Everything is DataFrame and SQL functions. A null URL, or one without ``://``, has an empty host and
path and no tokens, and is allowed. Rows with null or repeated ids and repeated rows are judged one by
one; only for labels do ids matter, and of several labels of an id the larger counts. Other columns
are not looked at.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaycast.llm.common import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "verdict=allow", "verdict=block"


class UrlRule(NamedTuple):
    verdict: str
    host: str
    path: str


# The listed rules.
LISTED = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)


class UrlParameters(NamedTuple):
    """Listed rules, and of mined ones the least ``support`` in labelled URLs and the least ``confidence``."""

    listed: tuple[UrlRule, ...] = LISTED
    support: int = 20
    confidence: float = 0.8


def url_parts(df: DataFrame, url: str) -> DataFrame:
    """Add scheme, host, path and tail (arguments and fragment) of the column ``url``."""
    at = f"instr({url}, '://')"
    split = df.selectExpr(
        "*",
        f"CASE WHEN {at} > 0 THEN lower(substring({url}, 1, {at} - 1)) ELSE '' END AS scheme",
        f"CASE WHEN {at} > 0 THEN substring({url}, {at} + 3) ELSE '' END AS rest",
    )
    split = split.selectExpr("*", "regexp_extract(rest, '^[^/?#]*', 0) AS authority")
    split = split.selectExpr("*", "substring(rest, length(authority) + 1) AS after")
    split = split.selectExpr(
        "*", f"translate(authority, '{UPPER}', '{LOWER}') AS host", "regexp_extract(after, '^[^?#]*', 0) AS path"
    )
    return split.selectExpr("*", "substring(after, length(path) + 1) AS tail").drop("rest", "authority", "after")


def listed_rule(rules: tuple[UrlRule, ...]) -> str:
    """SQL for the longest listed rule that fits ``host`` and ``path``: a struct of rule and verdict, or null."""
    if not rules:
        return "CAST(NULL AS STRUCT<length: INT, rule: STRING, verdict: STRING>)"

    def text(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    entries = ", ".join(
        f"CASE WHEN (host = {text(r.host)} OR endswith(host, {text('.' + r.host)})) AND startswith(path, {text(r.path)})"
        f" THEN named_struct('length', {len(r.host + r.path)}, 'rule', {text(r.host + r.path)}, 'verdict', {text(r.verdict)}) END"
        for r in rules
    )
    return f"array_max(filter(array({entries}), r -> r IS NOT NULL))"


# SQL for the distinct tokens of a URL's parts, in order of text.
TOKENS = """array_sort(array_distinct(CASE WHEN host = '' THEN CAST(array() AS ARRAY<STRING>) ELSE concat(
    array(concat('scheme=', scheme), concat('host=', host), concat('tld=', substring_index(host, '.', -1)),
          concat('domain=', substring_index(host, '.', -2)), concat('first=', substring_index(host, '.', 1))),
    transform(filter(split(path, '/'), s -> s <> ''), s -> concat('segment=', regexp_replace(s, '[0-9]+', '0'))),
    transform(filter(split(regexp_extract(tail, '^[?]([^#]*)', 1), '&'), s -> s <> ''),
              s -> concat('argument=', regexp_replace(s, '[0-9]+', '0'))),
    transform(filter(array(regexp_extract(tail, '#(.*)$', 1)), s -> s <> ''), s -> concat('fragment=', s))
) END))"""


def judged_parts(df: DataFrame, parameters: UrlParameters, page_id: str, url: str) -> DataFrame:
    """(page_id, host, path, rule, listed, tokens) of every row."""
    rows = url_parts(df.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url")), "url")
    rows = rows.selectExpr("*", f"{listed_rule(parameters.listed)} AS fit", f"{TOKENS} AS tokens")
    return rows.selectExpr("page_id", "host", "path", "fit.rule AS rule", "fit.verdict AS listed", "tokens")


def labelled_sets(parts: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(tokens, decided) of every URL that no listed rule decides and whose page has a label."""
    known = labels.where(f"{label} IN (0, 1)").groupBy("doc_id").agg(F.max(label).alias("allowed"))
    free = parts.where("listed IS NULL AND size(tokens) > 0")
    joined = free.join(known, free["page_id"] == known["doc_id"])
    return joined.selectExpr("tokens", f"CASE allowed WHEN 1 THEN '{ALLOW}' ELSE '{BLOCK}' END AS decided")


def token_items(labelled: DataFrame) -> DataFrame:
    """(token, item): tokens that occur in the same rows share an item, the first of them in text order.

    Token sets are counted first. Which sets a token is in is told by their number and two sums of
    hashes, added up before rows meet, so no token gathers its rows.
    """
    sets = labelled.groupBy("tokens").agg(F.count("*").alias("n"))
    spread = sets.selectExpr(
        "explode(tokens) AS token", "n", "xxhash64(tokens) AS one", "xxhash64(tokens, 'again') AS other"
    )
    marks = spread.groupBy("token").agg(
        F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("one", "other")]
    )
    marks = settle(marks, "url_marks")
    first = marks.groupBy("n", "one", "other").agg(F.min("token").alias("item"))
    return marks.join(first, ["n", "one", "other"]).select("token", "item")


def with_items(sets: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct rows of ``tokens`` with the ``items`` that they hold; tokens without an item are left out."""
    spread = sets.selectExpr("tokens", "explode(tokens) AS token").join(items, "token")
    return spread.groupBy("tokens").agg(F.array_sort(F.collect_set("item")).alias("items"))


def mine_rules(labelled: DataFrame, items: DataFrame, parameters: UrlParameters) -> DataFrame:
    """(items, verdict, confidence, support) of the rules that imply a verdict, without redundant ones."""
    sets = with_items(labelled.select("tokens").distinct(), items)
    baskets = labelled.join(sets, "tokens").selectExpr("concat(items, array(decided)) AS items")
    baskets = settle(baskets, "url_items")
    least = (parameters.support - 0.5) / max(baskets.count(), parameters.support)
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=parameters.confidence).fit(baskets)
    verdicts = model.associationRules.where(F.col("consequent")[0].isin(ALLOW, BLOCK))
    rules = settle(
        verdicts.selectExpr(
            "array_sort(antecedent) AS items", "substring_index(consequent[0], '=', -1) AS verdict", "confidence", "support"
        ),
        "url_rules",
    )
    # A rule without one of the items that has the same verdict and no less confidence makes it redundant.
    shorter = rules.selectExpr("items", "verdict", "confidence", "explode(items) AS item").selectExpr(
        "items", "verdict", "confidence", "array_remove(items, item) AS part"
    )
    known = rules.selectExpr("items AS part", "verdict", "confidence AS sure")
    covered = shorter.join(known, ["part", "verdict"]).where("sure >= confidence").select("items", "verdict").distinct()
    return rules.join(covered, ["items", "verdict"], "left_anti")


def match_rules(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(tokens, mined): the verdict of the best rule for each of the token sets with items that a rule matches."""
    entries = rules.selectExpr("items AS needed", "verdict", "confidence", "support", "explode(items) AS item")
    # Under the item that the fewest token sets have, so that an item of every URL files nothing else.
    every = sets.selectExpr("tokens", "items", "explode(items) AS item")
    spread = every.groupBy("item").agg(F.count("*").alias("sets"))
    index = settle(
        entries.join(spread, "item", "left")
        .groupBy("needed", "verdict", "confidence", "support")
        .agg(F.min(F.struct(F.coalesce("sets", F.lit(0)).alias("sets"), F.col("item"))).alias("rarest"))
        .selectExpr("needed", "verdict", "confidence", "support", "rarest.item AS item"),
        "url_index",
    )
    hits = every.join(index, "item").where("forall(needed, t -> array_contains(items, t))")
    order = F.struct("confidence", "support", (-F.size("needed")).alias("size"), "verdict")
    return hits.groupBy("tokens").agg(F.max_by("verdict", order).alias("mined"))


def judge_urls(
    df: DataFrame,
    labels: DataFrame,
    parameters: UrlParameters = UrlParameters(),
    page_id: str = "page_id",
    url: str = "url",
    label: str = "quality",
) -> DataFrame:
    """One row per row of ``df``: page_id, host, path, rule, verdict, and mined (the mined verdict, if any).

    ``labels`` has doc_id and ``label``.
    """
    parts = settle(judged_parts(df, parameters, page_id, url), "url_parts")
    labelled = settle(labelled_sets(parts, labels, label), "url_labelled")
    items = settle(token_items(labelled), "url_tokens")
    rules = mine_rules(labelled, items, parameters)
    sets = parts.where("listed IS NULL AND size(tokens) > 0").select("tokens").distinct()
    mined = settle(match_rules(settle(with_items(sets, items), "url_sets"), rules), "url_mined")
    judged = parts.withColumn("looked_up", F.expr("CASE WHEN listed IS NULL THEN tokens END"))
    mined = mined.withColumnRenamed("tokens", "looked_up")
    return judged.join(mined, "looked_up", "left").selectExpr(
        "page_id", "host", "path", "rule", "coalesce(listed, mined, 'allow') AS verdict", "mined"
    )


def oracle(parameters: UrlParameters) -> str:
    """SQL for page_id, host, path, rule, verdict, mined over ``pages`` and ``labels``: every subset of tokens is counted."""

    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    listed = " UNION ALL ".join(
        f"SELECT {text(r.verdict)} AS verdict, {text(r.host)} AS host, {text(r.path)} AS path" for r in parameters.listed
    )
    return f"""
    WITH listed AS ({listed}),
    cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN lower(substr(url, 1, strpos(url, '://') - 1)) ELSE '' END AS scheme,
        CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    hosts AS (SELECT page_id, scheme, rest, regexp_extract(rest, '^[^/?#]*') AS authority FROM cut),
    paths AS (SELECT page_id, scheme, translate(authority, '{UPPER}', '{LOWER}') AS host,
        substr(rest, length(authority) + 1) AS after FROM hosts),
    parts AS (SELECT row_number() OVER () AS n, page_id, scheme, host, regexp_extract(after, '^[^?#]*') AS path,
        substr(after, length(regexp_extract(after, '^[^?#]*')) + 1) AS tail FROM paths),
    fits AS (SELECT p.n, l.host || l.path AS rule, l.verdict,
        row_number() OVER (PARTITION BY p.n ORDER BY length(l.host || l.path) DESC) AS nth
        FROM parts p JOIN listed l ON (p.host = l.host OR ends_with(p.host, '.' || l.host)) AND starts_with(p.path, l.path)),
    words AS (
        SELECT n, 'scheme=' || scheme AS token FROM parts WHERE host <> ''
        UNION SELECT n, 'host=' || host FROM parts WHERE host <> ''
        UNION SELECT n, 'tld=' || regexp_extract(host, '[^.]*$') FROM parts WHERE host <> ''
        UNION SELECT n, 'domain=' || regexp_extract(host, '([^.]*[.])?[^.]*$') FROM parts WHERE host <> ''
        UNION SELECT n, 'first=' || regexp_extract(host, '^[^.]*') FROM parts WHERE host <> ''
        UNION SELECT n, 'segment=' || regexp_replace(s, '[0-9]+', '0', 'g')
            FROM (SELECT n, unnest(string_split(path, '/')) AS s FROM parts WHERE host <> '') WHERE s <> ''
        UNION SELECT n, 'argument=' || regexp_replace(s, '[0-9]+', '0', 'g')
            FROM (SELECT n, unnest(string_split(regexp_extract(tail, '^[?]([^#]*)', 1), '&')) AS s FROM parts WHERE host <> '') WHERE s <> ''
        UNION SELECT n, 'fragment=' || regexp_extract(tail, '#(.*)$', 1) FROM parts WHERE host <> '' AND regexp_extract(tail, '#(.*)$', 1) <> ''),
    numbered AS (SELECT n, token, row_number() OVER (PARTITION BY n ORDER BY token) - 1 AS bit FROM words),
    masks AS (SELECT n, unnest(range(1, CAST(power(2, max(bit) + 1) AS BIGINT))) AS mask FROM numbered GROUP BY n),
    subsets AS (SELECT m.n, m.mask, string_agg(w.token, ' ' ORDER BY w.token) AS part, count(*) AS size
        FROM masks m JOIN numbered w ON m.n = w.n AND CAST(floor(m.mask / power(2, w.bit)) AS BIGINT) % 2 = 1 GROUP BY m.n, m.mask),
    known AS (SELECT doc_id, max(quality) AS allowed FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
    decided AS (SELECT p.n, CASE k.allowed WHEN 1 THEN 'allow' ELSE 'block' END AS verdict
        FROM parts p JOIN known k ON p.page_id = k.doc_id WHERE p.host <> '' AND p.n NOT IN (SELECT n FROM fits)),
    counted AS (SELECT s.part, s.size, d.verdict, count(*) AS hits,
        sum(count(*)) OVER (PARTITION BY s.part) AS total
        FROM subsets s JOIN decided d ON s.n = d.n GROUP BY s.part, s.size, d.verdict),
    rules AS (SELECT part, size, verdict, CAST(hits AS DOUBLE) / total AS confidence, hits FROM counted
        WHERE hits >= {parameters.support} AND CAST(hits AS DOUBLE) / total >= {parameters.confidence}),
    best AS (SELECT s.n, r.verdict, row_number() OVER (PARTITION BY s.n ORDER BY r.confidence DESC, r.hits DESC, r.size, r.verdict DESC) AS nth
        FROM subsets s JOIN rules r ON s.part = r.part)
    SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, b.verdict, 'allow') AS verdict,
        CASE WHEN f.verdict IS NULL THEN b.verdict END AS mined
    FROM parts p LEFT JOIN fits f ON p.n = f.n AND f.nth = 1 LEFT JOIN best b ON p.n = b.n AND b.nth = 1"""
