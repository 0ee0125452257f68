"""URL filter: rules by host and path, and a logistic regression for all other URLs.

Features are hashed character n-grams of the lower-cased host and of the path, told apart
by a prefix and marked at both ends. The model is fitted on a small labelled table of URLs
(``labelled_urls`` unless another is given) with Spark's own logistic regression, so fitting
and scoring stay on the JVM; its size is fixed by ``FEATURES`` whatever the corpus.

A rule fits its host and all subdomains if the URL's path starts with the rule's path; the
longest rule that fits decides. The list of rules is a parameter and short: it becomes one
expression.

Results for odd input: a null URL, or one without ``://``, has an empty host and path, fits
no rule, and is judged by what the model makes of no features but the end marks; rows that
repeat an id are judged one by one; an empty table gives an empty table. Work is linear in
the length of a URL.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stackroom.llm.common import ascii_lower

FEATURES = 1 << 14
GRAMS = (3, 4)
MAX_LABELLED = 10_000
THRESHOLD = 0.5
REGULARISATION = 0.0005
BLOCK_WEIGHT = 2.0  # the labelled table has more names to allow

#: Rules (host, path, verdict) of the query.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

#: Words of hosts to block and of hosts to allow, of which the labelled table is made.
BLOCKED_WORDS = (
    "casino poker bet bets betting jackpot slots roulette pills viagra cialis pharma steroids adult xxx porn sex escort cams "
    "spam ads adserver banner track tracker clicks loan payday credit cash prize winner win claim warez crack keygen torrent "
    "replica cheap free bonus hack botnet phish malware"
).split()
ALLOWED_WORDS = (
    "library museum garden school news weather science history travel music kitchen forum city council hospital journal "
    "archive bridge river north market theatre station letters paper method reason national thermal heather nation tension "
    "either thread mention farm window friend author water village cathedral physics lesson recipe theory other another"
).split()
#: Common syllables; names made of them mean nothing and are allowed.
SYLLABLES = "an be con da der ed el en er es ge ha he in is la le men ne no on or pa ra re sa sh sta te th the thing ti tion to ver wa".split()
FRAMES = 3  # URLs of each name


def labelled_rows() -> list[tuple[str, float]]:
    """URLs made of the words, alone and in pairs, in the same frames for both labels: so the
    words decide, and neither the subdomain nor the language or shape of the path."""
    rows = []
    made = [a + b + c for k, a in enumerate(SYLLABLES) for b, c in zip(SYLLABLES[k % 5 :: 5], SYLLABLES[::-5])]
    for label, words, more in ((1.0, BLOCKED_WORDS, []), (0.0, ALLOWED_WORDS, made)):
        names = words + [f"{a}-{b}" for a, b in zip(words, words[7:] + words[:7])] + more
        for k, name in enumerate(names * FRAMES):
            subdomain = ("", "www.", "m.", "blog.")[k % 4]
            language = ("en", "fr", "de", "es")[k // 4 % 4]
            ending = ("", ".html", "/", "?page=2", "#top")[k % 5]
            rows.append((f"https://{subdomain}{name}.example.{('com', 'org', 'net')[k % 3]}/{language}/{17 * k % 97}{ending}", label))
    return rows


def host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0))


def path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def grams(text: Column, mark: str) -> Column:
    """Character n-grams of the text between its end marks; one cut into characters."""
    cut = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")

    def of_size(characters: Column, n: int) -> Column:
        starts = F.when(F.size(characters) >= n, F.sequence(F.lit(1), F.size(characters) - n + 1))
        starts = F.coalesce(starts, F.array().cast("array<int>"))
        return F.transform(starts, lambda at: F.concat(F.lit(mark), F.array_join(F.slice(characters, at, F.lit(n)), "")))

    # As the argument of a function the characters are cut once, not at each n-gram anew.
    return F.flatten(F.transform(F.array(cut), lambda characters: F.concat(*[of_size(characters, n) for n in GRAMS])))


def with_grams(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``host`` and ``path``) and their n-grams."""
    return rows.withColumn("grams", F.concat(grams(F.col("host"), "h:"), grams(F.col("path"), "p:")))


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(labelled_rows(), "url string, label double")


def trained(labelled: DataFrame) -> PipelineModel:
    """The model for ``labelled`` (``url, label``; 1 is block), of which at most
    ``MAX_LABELLED`` rows are read: the table is small by its meaning."""
    rows = labelled.limit(MAX_LABELLED).select(host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "label")
    rows = rows.withColumn("weight", F.when(F.col("label") == 1.0, BLOCK_WEIGHT).otherwise(1.0))
    counts = HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)
    model = LogisticRegression(maxIter=50, regParam=REGULARISATION, threshold=THRESHOLD, weightCol="weight")
    return Pipeline(stages=[counts, model]).fit(with_grams(rows))


def matched_rule(rules: tuple[tuple[str, str, str], ...], at_host: Column, at_path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, decision in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the longest comes out on top
        fits = ((at_host == rule_host) | at_host.endswith("." + rule_host)) & at_path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def judged(
    pages: DataFrame,
    model: PipelineModel,
    rules: tuple[tuple[str, str, str], ...] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row."""
    url = F.coalesce(F.col(f"`{url_col}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), host(url).alias("host"), path(url).alias("path"))
    rule, verdict = matched_rule(rules, F.col("host"), F.col("path"))
    scored = model.transform(with_grams(rows))
    by_model = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_model).alias("verdict"))
