"""URL filters: explicit rules, then association rules mined from labelled pages.

FP-growth finds combinations of URL tokens that go with bad labels. As it lists
every subset of what it is given, it is given little: tokens that stand on the
same pages are one item, and where a page still has many items, the pages of each
item are looked at by themselves (as FP-growth does inside), where items that all
of them have say nothing and more items fall together. So a rule has alternatives
in each of its places, and any number of tokens. Rules are pruned by support, by
the lower bound of their confidence, and if a shorter one is as confident; they
are filed under the tokens of their rarest place, and a URL is checked only
against the rules filed under its own tokens.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from millwright.workspace import stage

from .common import ascii_lower

# Fixed values of the contract: verdict, host, path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

BAD = "label=bad"
MIN_PAGES = 30  # bad pages of a rule, or
MIN_SHARE = 1e-5  # this share of the labelled pages, which bounds the items that FP-growth lists on the driver
Z = 2.0  # standard deviations below a rule's confidence that its lower bound lies;
LEAST = 0.5  # this must be above a half: its pages are more likely bad than not,
LIFT = 1.5  # and so many times the share of bad pages
FEW = 12  # items of a page: FP-growth lists at most 2 ** 12 sets of them
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(url, URL_PARTS, 1)), F.regexp_extract(url, URL_PARTS, 2)


def rule_match(host: Column, path: Column, rules=tuple(RULES)) -> Column:
    """Struct(rule, verdict) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        this = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, this).otherwise(found)
    return found


def url_tokens(url: Column) -> Column:
    """Distinct tokens: scheme, host, its labels and parent domain, path segments, query keys, fragment."""
    host, path = host_and_path(url)
    url = F.coalesce(url, F.lit(""))
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    parent = F.when(F.size(labels) >= 2, F.array(F.concat(F.lit("domain="), F.array_join(F.slice(labels, -2, 2), ".")))).otherwise(F.array().cast("array<string>"))
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    plain = F.transform(segments, lambda x: F.concat(F.lit("path="), F.regexp_replace(x, "[0-9]+", "0")))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    keys = F.transform(
        F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("key="), F.split_part(x, F.lit("="), F.lit(1)))
    )
    scheme = F.array(F.concat(F.lit("scheme="), F.regexp_extract(url, r"(?s)^(.*?)://", 1)))
    whole = F.array(F.concat(F.lit("host="), host))
    marked = F.transform(labels, lambda x: F.concat(F.lit("label-of-host="), x))
    return F.array_distinct(F.concat(scheme, whole, parent, marked, plain, keys))


_ALTERNATIVES = "array<array<string>>"


def _merged(rows: DataFrame, least: int) -> DataFrame:
    """The items of each prefix: prefix, item, alts, n, n_bad.

    `rows` has prefix, prefix_n (pages that have it), basket, bad, item, alts. Items
    with too few bad pages can be in no rule; those on all pages of the prefix
    add nothing to it; those on the same pages are one item.
    """
    counts = rows.groupBy("prefix", "prefix_n", "item").agg(
        F.first("alts").alias("alts"), F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("n_bad"),
        F.bit_xor(F.xxhash64("basket")).alias("x1"), F.bit_xor(F.xxhash64(F.lit(1), "basket")).alias("x2"),
    )
    telling = counts.filter((F.col("n_bad") >= least) & (F.col("n") < F.col("prefix_n")))
    return telling.groupBy("prefix", "n", "n_bad", "x1", "x2").agg(
        F.min("item").alias("item"), F.flatten(F.collect_list("alts")).alias("alts")
    ).select("prefix", "item", "alts", "n", "n_bad")


def _rebuilt(rows: DataFrame, items: DataFrame) -> DataFrame:
    """prefix, basket, bad, items (n, item, n_bad, alts; rarest first) of pages, with `wide`: the most items of a page of the prefix."""
    named = items.select(F.col("prefix").alias("of"), F.col("item").alias("named"), F.struct("n", "item", "n_bad", "alts").alias("entry"))
    kept = rows.join(named, (F.col("prefix") == F.col("of")) & (F.col("item") == F.col("named")))
    pages = kept.groupBy("prefix", "basket").agg(F.first("bad").alias("bad"), F.sort_array(F.collect_list("entry")).alias("items"))
    widest = pages.groupBy(F.col("prefix").alias("of")).agg(F.max(F.size("items")).alias("wide"))
    return pages.join(widest, F.col("prefix") == F.col("of")).drop("of")


def _narrowed(pages: DataFrame) -> DataFrame:
    """For each item of a page, the page by itself: the item joins the prefix, and items that are more frequent stay.

    Every set of items has one rarest, so it is found behind that one alone. An
    item with bad pages only needs no others beside it.
    """
    each = pages.select("prefix", "basket", "bad", "items", F.posexplode("items").alias("at", "own"))
    open_ = each.filter(F.col("own.n_bad") < F.col("own.n"))
    longer = F.concat("prefix", F.array("own.alts")).alias("prefix")
    rest = F.explode(F.slice("items", F.col("at") + 2, F.size("items"))).alias("entry")
    return open_.select(longer, F.col("own.n").alias("prefix_n"), "basket", "bad", rest).select(
        "prefix", "prefix_n", "basket", "bad", F.col("entry.item").alias("item"), F.col("entry.alts").alias("alts")
    )


def _name(item: Column | str) -> Column:
    """An item together with its prefix; equal items behind different prefixes are told apart."""
    return F.concat(F.md5(F.to_json("prefix").cast("binary")), F.lit(":"), item)


def _frequent_sets(pages: DataFrame, least: int) -> DataFrame:
    """alternatives, n, n_bad of all sets of items with enough bad pages, by FP-growth over pages of few items."""
    marked = F.when(F.col("bad"), F.array(_name(F.lit(BAD)))).otherwise(F.array().cast("array<string>"))
    names = F.col("items.item")
    baskets = stage(pages.select(F.concat(F.transform(names, _name), marked).alias("items")))
    n_rows = baskets.count()
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / max(1, n_rows)), minConfidence=0.5).fit(baskets)
    is_bad = lambda x: x.endswith(F.lit(":" + BAD))
    sets = stage(model.freqItemsets.select(
        F.sort_array(F.filter("items", lambda x: ~is_bad(x))).alias("names"), F.exists("items", is_bad).alias("with_bad"), "freq"
    ))
    bad = sets.filter(F.col("with_bad") & (F.size("names") > 0)).select(F.col("names").alias("bad_names"), F.col("freq").alias("n_bad"))
    counted = sets.filter(~F.col("with_bad")).join(bad, F.col("names") == F.col("bad_names"))
    counted = stage(counted.select(F.monotonically_increasing_id().alias("set"), "names", F.col("freq").alias("n"), "n_bad"))
    meaning = pages.select("prefix", F.explode("items").alias("entry")).groupBy(_name(F.col("entry.item")).alias("name")).agg(
        F.first("prefix").alias("prefix"), F.first("entry.alts").alias("alts")
    )
    spelled = counted.select("set", F.explode("names").alias("name")).join(meaning, "name")
    places = spelled.groupBy("set").agg(F.first("prefix").alias("prefix"), F.collect_list("alts").alias("places"))
    return counted.join(places, "set").select(F.concat("prefix", "places").alias("alternatives"), "n", "n_bad")


def lower_bound(n_bad: Column, n: Column, z: float = Z) -> Column:
    """Of the share n_bad / n, by Wilson's interval."""
    share = n_bad / n
    return (share + z * z / (2 * n) - z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def _telling(sets: DataFrame, base: float, least: float, lift: float, z: float) -> DataFrame:
    bound = lower_bound(F.col("n_bad"), F.col("n"), z)
    kept = sets.filter((bound > least) & (bound >= lift * base))
    return kept.withColumn("confidence", F.col("n_bad") / F.col("n"))


def _without_longer(rules: DataFrame) -> DataFrame:
    """Rules of which no shorter one, fitting wherever they fit, is as confident."""
    places = F.transform("alternatives", lambda x: F.array_sort(x))
    rules = stage(rules.withColumn("alternatives", places).withColumn("rule_id", F.monotonically_increasing_id()))
    shorter = rules.select(
        F.col("alternatives").alias("short"), F.col("confidence").alias("short_confidence"), F.explode(F.col("alternatives")[0]).alias("token")
    )
    longer = rules.select("rule_id", "alternatives", "confidence", F.explode(F.array_distinct(F.flatten("alternatives"))).alias("token"))
    inside = F.forall("short", lambda s: F.exists("alternatives", lambda a: F.size(F.array_except(a, s)) == 0))
    covers = (F.size("short") < F.size("alternatives")) & (F.col("short_confidence") >= F.col("confidence")) & inside
    covered = longer.join(shorter, "token").filter(covers).select("rule_id").distinct()
    return rules.join(covered, "rule_id", "left_anti")


def mine_rules(
    labelled_urls: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, least: float = LEAST, lift: float = LIFT, z: float = Z
) -> DataFrame | None:
    """(rule_id, alternatives, keys, confidence, n, n_bad), or None where nothing can be mined.

    `labelled_urls` has url and bad (boolean). A rule fits a URL that has a token of
    each of its places. It needs `min_pages` bad pages (or `min_share` of all), and
    the lower bound of its confidence above `least` and `lift` times the share of
    bad pages: a few pages prove nothing, nor does what is no worse than the rest.
    `keys` are the tokens of its rarest place.
    """
    baskets = stage(labelled_urls.select(
        F.monotonically_increasing_id().alias("basket"), F.coalesce("bad", F.lit(False)).alias("bad"), url_tokens(F.col("url")).alias("tokens")
    ))
    total, bad = baskets.agg(F.count(F.lit(1)), F.count_if("bad")).first()
    support = max(1, min_pages, int(-(-min_share * total // 1)))
    if bad < support:
        return None
    rows = baskets.select(
        F.array().cast(_ALTERNATIVES).alias("prefix"), F.lit(total).cast("bigint").alias("prefix_n"), "basket", "bad",
        F.explode("tokens").alias("item"),
    ).withColumn("alts", F.array("item"))
    found = []
    while True:  # the items of a page get fewer each time
        items = stage(_merged(rows, support))
        pages = stage(_rebuilt(rows, items))
        few = pages.filter(F.col("wide") <= FEW)
        if not few.isEmpty():
            found.append(_frequent_sets(few, support))
        many = pages.filter(F.col("wide") > FEW)
        if many.isEmpty():
            break
        wide = many.select(F.col("prefix").alias("of")).distinct()
        single = items.join(wide, F.col("prefix") == F.col("of"), "left_semi")
        found.append(single.select(F.concat("prefix", F.array("alts")).alias("alternatives"), "n", "n_bad"))
        rows = stage(_narrowed(many))
    if not found:
        return None
    sets = reduce(DataFrame.unionByName, found)
    rules = _without_longer(_telling(sets, bad / total, least, lift, z))
    # The rarest place by the pages of its tokens.
    sizes = baskets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("freq"))
    each = rules.select("rule_id", F.posexplode("alternatives").alias("place", "place_tokens"))
    held = each.select("rule_id", "place", "place_tokens", F.explode("place_tokens").alias("token")).join(sizes, "token")
    places = held.groupBy("rule_id", "place").agg(F.first("place_tokens").alias("tokens"), F.sum("freq").alias("freq"))
    keys = places.groupBy("rule_id").agg(F.min_by("tokens", F.struct("freq", "place")).alias("keys"))
    return stage(rules.join(keys, "rule_id").select("rule_id", "alternatives", "keys", "confidence", "n", "n_bad"))


def mined_blocks(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct urls that some rule fits, with the best rule's confidence."""
    own = urls.select("url").distinct().withColumn("own", url_tokens(F.col("url")))
    filed = rules.select("alternatives", "confidence", F.explode("keys").alias("key"))
    met = own.select("url", "own", F.explode("own").alias("key")).join(filed, "key")
    hit = met.filter(F.forall("alternatives", lambda tokens: F.arrays_overlap(tokens, F.col("own"))))
    return hit.groupBy("url").agg(F.max("confidence").alias("confidence"))


def judge_urls(pages: DataFrame, labels: DataFrame, **mining) -> DataFrame:
    """page_id, host, path, rule, verdict, confidence, for each row of `pages`.

    Labels meet pages by doc_id = page_id; a page is bad if its quality is 0 or
    it is toxic, and null marks are not held against it. A page without an
    explicit rule is blocked if a mined rule fits, else allowed. A null url has
    empty host and path. Rows with null ids are judged, but teach nothing;
    repeated rows come back as often and count as often. Empty tables give no
    rows, and without labels nothing is mined. A very long url has as many tokens
    as it has parts, all of which count. Other columns are not read.
    """
    marks = labels.select(
        F.col("doc_id").alias("page_id"),
        (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad"),
    )
    narrow = pages.select("page_id", "url")
    rules = mine_rules(narrow.join(marks, "page_id"), **mining)
    host, path = host_and_path(F.col("url"))
    judged = narrow.select("page_id", "url", host.alias("host"), path.alias("path")).withColumn(
        "found", rule_match(F.col("host"), F.col("path"))
    )
    if rules is None:
        judged = judged.withColumn("confidence", F.lit(None).cast("double"))
    else:
        judged = judged.join(mined_blocks(narrow.filter("url is not null"), rules), "url", "left")
    mined = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", mined).alias("verdict"), "confidence",
    )
