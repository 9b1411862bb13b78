"""Host and path rules for URLs, and a character model that judges the URLs no rule fits.

DataFrame functions only. The model is a pair of smoothed Markov models of variable order over a
32-symbol alphabet, one for accepted and one for rejected URLs. Their log-probabilities are written
so that every substring of a URL adds a weight of its own; scoring is then one join and one sum, and
the weight table has at most 32 + 32^2 + 32^3 + 32^4 rows whatever the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.tables import narrow, stored

#: (verdict, rule): a host, which stands for its subdomains too, and the start of a path.
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
LONGEST = 4
#: Weights and scores are whole numbers of this unit: sums do not depend on their order.
UNIT = 1 << 20
#: Of the URLs that a rule fits, one in this many sets the threshold and is not counted.
HELD = 5


def host(url: Column) -> Column:
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def symbols(url: Column) -> Column:
    """The URL in 31 symbols: letters without case, 0 for digits, ``. / -``, _ for the rest; $ ends it."""
    plain = F.translate(
        url,
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789",
        "abcdefghijklmnopqrstuvwxyz000000000",
    )
    return F.concat(F.regexp_replace(plain, "[^a-z0./-]", "_"), F.lit("$"))


def ruled(pages: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Adds ``rule`` and ``said`` of the longest rule that fits, null where none does."""
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1], r[0])):
        name, slash, rest = rule.partition("/")
        at_host = (F.col("host") == name) | F.col("host").endswith("." + name)
        fits.append((at_host & F.col("path").startswith(slash + rest), rule, verdict))
    rule, said = F.lit(None).cast("string"), F.lit(None).cast("string")
    for fit, text, verdict in reversed(fits):
        rule = F.when(fit, F.lit(text)).otherwise(rule)
        said = F.when(fit, F.lit(verdict)).otherwise(said)
    return pages.withColumn("rule", rule).withColumn("said", said)


def _grams(text: Column) -> Column:
    """All substrings of 1 to LONGEST symbols."""
    return F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.length(text)),
            lambda i: F.transform(
                F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length(text) - i + 1)),
                lambda k: text.substr(i, k),
            ),
        )
    )


def _class_weights(counts: DataFrame) -> DataFrame:
    """``(said, gram, n)`` -> ``(said, gram, value)``: what a gram adds to the log-probability.

    Witten-Bell smoothing: after a context that n symbols of t kinds followed, a symbol seen c times
    has (c + t * q) / (n + t), with q its probability after the context less its first symbol, and 1
    in 32 at the end of that chain. A gram's value is what this adds to t / (n + t) * q, plus
    log(t / (n + t)) of the gram as a context. So the values of a text's grams add up to its
    log-probability, but for a constant for each symbol.
    """
    before = F.expr("left(gram, length(gram) - 1)")
    contexts = (
        counts.withColumn("context", before)
        .groupBy("said", "context")
        .agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    )
    share = F.col("kinds") / (F.col("total") + F.col("kinds"))
    known = (
        counts.withColumn("context", before)
        .join(contexts, ["said", "context"])
        .select("said", "gram", F.length("gram").alias("m"), (F.col("n") / (F.col("total") + F.col("kinds"))).alias("own"), share.alias("share"))
    )
    shorter, levels = None, []
    for m in range(1, LONGEST + 1):
        here = known.filter(F.col("m") == m)
        if shorter is None:
            here = here.withColumn("q", F.lit(1 / 32.0))
        else:
            tail = shorter.select("said", F.col("gram").alias("tail"), F.col("p").alias("q"))
            here = here.withColumn("tail", F.expr("substring(gram, 2)")).join(tail, ["said", "tail"])
        backed = F.col("share") * F.col("q")
        here = here.select(
            "said", "gram", (F.col("own") + backed).alias("p"),
            F.ln((F.col("own") + backed) / backed).alias("gain"),
        )
        levels.append(here.select("said", "gram", "gain"))
        shorter = here
    gains = levels[0]
    for level in levels[1:]:
        gains = gains.union(level)
    follow = contexts.select("said", F.col("context").alias("gram"), F.ln(share).alias("back"))
    return gains.join(follow, ["said", "gram"], "full").select(
        "said", "gram",
        (F.coalesce("gain", F.lit(0.0)) + F.coalesce("back", F.lit(0.0))).alias("value"),
    )


def model(known: DataFrame) -> DataFrame:
    """``(said, text)`` of ruled URLs -> ``(gram, weight)``: accepted less rejected, in UNITs.

    The empty gram's weight is a constant for each symbol.
    """
    grams = known.select("said", F.explode(_grams(F.col("text"))).alias("gram"))
    counts = grams.groupBy("said", "gram").agg(F.count(F.lit(1)).alias("n"))
    values = _class_weights(stored(counts, "grams"))
    sign = F.when(F.col("said") == "allow", F.col("value")).otherwise(-F.col("value"))
    return values.groupBy("gram").agg(F.round(F.sum(sign) * UNIT).cast("long").alias("weight"))


def judge(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)`` for each row.

    A rule fits its host and all subdomains if the path starts as the rule's does; the longest one
    decides. Elsewhere the verdict is ``allow`` if the score is at least 0: the mean over the URL's
    symbols of the log-likelihood difference, accepted less rejected, in millionths, less the point
    half way between the mean scores of held-back accepted and rejected URLs. The models count every
    other URL that a rule fits.

    Null URLs and URLs without ``://`` have an empty host and path, so no rule fits; a null or empty
    URL is scored as one end symbol. With no accepted or no rejected URL to learn from or to hold
    back, scores are 0 less what is missing, so unruled URLs are allowed when both are. Repeated
    rows count and are judged as often as they occur; null ids are kept. An empty table gives an
    empty result; other columns are left out.
    """
    own = narrow(pages, page_id=id_col, url=url_col)
    rows = ruled(own.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))}), rules)
    text = symbols(F.coalesce("url", F.lit("")))
    digest = F.conv(F.substring(F.md5(F.coalesce("url", F.lit(""))), 1, 4), 16, 10)
    bucket = digest.cast("long") % HELD
    rows = rows.select("page_id", "host", "path", "rule", "said", text.alias("text"), bucket.alias("held"))
    # A URL is scored once however many rows repeat it.
    texts = rows.groupBy("text").agg(F.count(F.lit(1)).alias("rows"))
    known = rows.filter("said IS NOT NULL AND held > 0").select("said", "text")
    weights = stored(model(known), "weights")
    grams = texts.select(
        "text",
        F.explode(F.concat(_grams(F.col("text")), F.array_repeat(F.lit(""), F.length("text")))).alias("gram"),
    )
    # The alphabet and LONGEST bound this table, so every executor can hold it.
    sums = (
        grams.join(F.broadcast(weights), "gram")
        .groupBy("text")
        .agg(F.sum("weight").alias("total"))
    )
    mean = F.round(F.col("total") * (1_000_000.0 / UNIT) / F.length("text")).cast("long")
    scores = stored(
        texts.select("text").join(sums, "text", "left").select(
            F.col("text").alias("name"), F.coalesce(mean, F.lit(0)).alias("mean")
        ),
        "scores",
    )
    scored = rows.join(scores, F.col("text") == F.col("name"))
    middle = (
        scored.filter("said IS NOT NULL AND held = 0")
        .groupBy()
        .agg(
            *(
                (F.sum(F.when(F.col("said") == said, F.col("mean"))) / F.sum(F.when(F.col("said") == said, 1))).alias(said)
                for said in ("allow", "block")
            )
        )
        .select(F.round(F.coalesce((F.col("allow") + F.col("block")) / 2, F.lit(0.0))).cast("long").alias("middle"))
    )
    # One row, from an aggregate without keys.
    point = middle.first()["middle"]
    score = F.col("mean") - F.lit(point).cast("long")
    learned = F.when(score >= 0, F.lit("allow")).otherwise(F.lit("block"))
    return scored.select(
        "page_id", "host", "path", "rule",
        F.coalesce("said", learned).alias("verdict"), score.alias("score"),
    )


_FITS = " ".join(
    f"WHEN (host = '{r.split('/')[0]}' OR ends_with(host, '.{r.split('/')[0]}')) "
    f"AND starts_with(path, '{r[r.index('/') :]}') THEN '{r}'"
    for _, r in sorted(RULES, key=lambda r: (-len(r[1]), r[1], r[0]))
)
_SAYS = " ".join(f"WHEN '{r}' THEN '{v}'" for v, r in RULES)


def _level(m: int) -> str:
    if m == 1:
        return "p1 AS (SELECT said, gram, own, share, 0.03125::DOUBLE AS q FROM o WHERE m = 1)"
    return f"""p{m} AS (SELECT o.said, o.gram, o.own, o.share, s.own + s.share * s.q AS q
  FROM o JOIN p{m - 1} s ON o.said = s.said AND substr(o.gram, 2) = s.gram WHERE o.m = {m})"""


SQL = f"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
v AS (SELECT *, CASE {_FITS} END AS rule FROM u),
r AS (SELECT page_id, host, path, rule, CASE rule {_SAYS} END AS said,
    regexp_replace(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789',
      'abcdefghijklmnopqrstuvwxyz000000000'), '[^a-z0./-]', '_', 'g') || '$' AS text,
    ('0x' || substr(md5(url), 1, 4))::BIGINT % {HELD} AS held FROM v),
n AS (SELECT said, text, unnest(range(1, length(text) + 1)) AS i FROM r
  WHERE said IS NOT NULL AND held > 0),
c AS (SELECT said, substr(text, i, k) AS gram, count(*)::DOUBLE AS n
  FROM n, range(1, {LONGEST + 1}) AS t(k) WHERE i + k - 1 <= length(text) GROUP BY ALL),
x AS (SELECT said, left(gram, length(gram) - 1) AS context, sum(n) AS total, count(*)::DOUBLE AS kinds
  FROM c GROUP BY ALL),
o AS (SELECT c.said, c.gram, length(c.gram) AS m, n / (total + kinds) AS own,
    kinds / (total + kinds) AS share
  FROM c JOIN x ON c.said = x.said AND left(c.gram, length(c.gram) - 1) = x.context),
{",".join(_level(m) for m in range(1, LONGEST + 1))},
g AS ({" UNION ALL ".join(f"SELECT said, gram, ln((own + share * q) / (share * q)) AS gain FROM p{m}" for m in range(1, LONGEST + 1))}),
b AS (SELECT said, context AS gram, ln(kinds / (total + kinds)) AS back FROM x),
f AS (SELECT said, gram, coalesce(gain, 0) + coalesce(back, 0) AS value
  FROM g FULL JOIN b USING (said, gram)),
w AS (SELECT gram, round(sum(CASE said WHEN 'allow' THEN value ELSE -value END) * {UNIT})::BIGINT AS weight
  FROM f GROUP BY gram),
d AS (SELECT text, unnest(range(1, length(text) + 1)) AS i FROM (SELECT DISTINCT text FROM r)),
e AS (SELECT text, CASE k WHEN 0 THEN '' ELSE substr(text, i, k) END AS gram
  FROM d, range(0, {LONGEST + 1}) AS t(k) WHERE i + k - 1 <= length(text)),
s AS (SELECT text, round(sum(weight)::DOUBLE * ({1_000_000.0 / UNIT!r}::DOUBLE) / length(text))::BIGINT AS mean
  FROM e JOIN w USING (gram) GROUP BY text),
a AS (SELECT r.*, coalesce(mean, 0) AS mean FROM r LEFT JOIN s USING (text)),
h AS (SELECT round(coalesce((sum(mean) FILTER (said = 'allow')::DOUBLE / count(*) FILTER (said = 'allow')
    + sum(mean) FILTER (said = 'block')::DOUBLE / count(*) FILTER (said = 'block')) / 2, 0))::BIGINT AS middle
  FROM a WHERE said IS NOT NULL AND held = 0)
SELECT page_id, host, path, rule, mean - middle AS score,
  coalesce(said, CASE WHEN mean >= middle THEN 'allow' ELSE 'block' END) AS verdict
FROM a, h
"""
