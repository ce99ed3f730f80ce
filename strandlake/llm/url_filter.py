"""URL filter: logistic regression on hashed character n-grams, under rules.

Host and path are cut out of the url with SQL functions. A host and its path
become character 3- to 5-grams (hosts fenced by "^" and "$", so that the ends
count), host and path grams in separate name spaces, hashed into ``DIMS``
places. A logistic model trained on a small labelled table scores them; a rule
that fits overrides the model.

Everything runs in the JVM: SQL functions, the DataFrame-based hashing and
logistic regression, and one broadcast weight vector of fixed size.

Null urls and urls without "://" have empty host and path; like urls with an
empty host they are judged by what is left of them (no grams: the model's
intercept alone). Urls may be of any length; repeated rows are judged alike and
keep one result row each, whatever their ids. Of rules that are equally long,
the later one wins. An empty table gives an empty result. Only the url and id
columns are read, so extra columns and their names don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIMS = 1 << 16
ROWS_PER_CLASS, REG = 2000, 3e-3


@dataclass(frozen=True)
class Rule:
    """``host`` and all its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed by the contract.
RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))

#: Words that mark unwanted and wanted hosts; the labelled table pairs them.
UNWANTED = tuple(
    """casino poker roulette jackpot slots gambling betting bookmaker bets wager viagra cialis pharma pills steroid
    porn xxx escort adult hookup camgirls nude spam bulkmail clickbait doorway ads adserver banner popunder tracking
    track pixel malware keygen warez torrent cracked replica fakewatches payday loans getrich lottery winbig""".split()
)
WANTED = tuple(
    """library history garden physics news data music museum recipes travel weather science parish linguist theory
    cinema school college church hospital council river forest mountain cycling football chess knitting bakery
    painting poetry grammar atlas archive journal review kitchen farming harbour railway theatre orchestra astronomy
    biology chemistry geology medicine nursing law justice parliament village island bridge castle market winter
    summer family children teacher student letters stories novel dictionary calendar photo camera software compiler
    kernel python database network forum blogger diary hiking fishing sailing horses birds insects flowers herbs
    adder adopt address reader trader wineries winter window tracker trackside racetrack pixelart analysis essex
    scunthorpe assembly classic cockpit bassist specialist socialist""".split()
)


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to "?", "#" or the end."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table: ``url, label`` (1: unwanted). Each word stands
    alone and beside others of its class in hosts and paths; both classes get
    the same affixes, so that these say nothing."""
    fronts, ends = ("", "www.", "blog.", "m.", "shop.", "en.", "my."), (".com", ".example.com", ".net", ".example.net", ".org", ".example.org", ".info", ".biz", ".co.uk", ".de", ".fr")
    places = ("/", "/index.html", "/en/7.html", "/de/12", "/fr/3/", "/es/9", "/a/b/c", "", "/p/2024/05/1", "/list", "/x.js", "/go", "/search", "/home/")
    shapes = ("{0}", "{0}24", "my{0}", "the-{0}", "best-{0}", "{0}-online", "new{0}s", "e{0}", "{0}{1}", "{0}-{1}", "{1}{0}", "{0}{1}hub", "top{0}", "{0}4u")
    rows = []
    for label, words in ((1.0, UNWANTED), (0.0, WANTED)):
        n = len(words)
        for j in range(ROWS_PER_CLASS):  # the j-th row of both classes has the same shape and affixes
            word, other = words[j % n], words[(j + 1 + j // n * 5) % n]
            at = j * 40_503 + j // 7
            name = shapes[at % len(shapes)].format(word, other)
            host, place = f"{fronts[at // 14 % 7]}{name}{ends[at // 98 % 11]}", places[at // 1078 % 14]
            rows.append((f"{('http', 'https')[j % 2]}://{host}{place}" if j % 8 else f"file:///{word}{('/', '-', '_')[j // 8 % 3]}{other}{place}", label))
            if j % 12 == 5:
                rows.append((f"https://site{at % 9}{ends[at // 98 % 11]}/{word}-{other}{place}", label))
    return spark.createDataFrame(rows, "url string, label double")


def _grams(text: Column, mark: str, sizes: tuple[int, ...] = (3, 4, 5)) -> Column:
    def of(n: int) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1)))
        # a function of one argument: with a second one transform() would pass the index
        return F.when(F.length(text) >= n, F.transform(places, lambda i: F.concat(F.lit(mark), F.substr(text, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))

    return F.concat(*[of(n) for n in sizes])


def _with_features(table: DataFrame, host: Column, path: Column) -> DataFrame:
    digits = F.regexp_replace(path, "[0-9]+", "0")
    grams = F.concat(_grams(F.concat(F.lit("^"), host, F.lit("$")), "h"), _grams(digits, "p"))
    return HashingTF(numFeatures=DIMS, binary=True, inputCol="__sl_grams", outputCol="__sl_features").transform(table.withColumn("__sl_grams", grams))


def fit(labelled: DataFrame, url: str = "url", label: str = "label", wanted_weight: float = 4.0) -> LogisticRegressionModel:
    """A wanted url weighs ``wanted_weight`` times an unwanted one, so names
    that say nothing are allowed."""
    weight = F.when(F.col(label) == 0, wanted_weight).otherwise(1.0)
    table = _with_features(labelled.select(F.col(url).alias("u"), F.col(label).cast("double").alias("label"), weight.alias("weight")), host_of(F.col("u")), path_of(F.col("u")))
    learner = LogisticRegression(featuresCol="__sl_features", labelCol="label", weightCol="weight", predictionCol="__sl_prediction", probabilityCol="__sl_probability", rawPredictionCol="__sl_raw", regParam=REG, maxIter=60, aggregationDepth=2)
    return learner.fit(table.coalesce(1))


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits (null where none does)."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, model: LogisticRegressionModel, rules: tuple[Rule, ...] = RULES, url: str = "url", id_col: str = "page_id", threshold: float = 0.5) -> DataFrame:
    """``id_col, host, path, rule, verdict, score`` of every row."""
    table = pages.select(F.col(id_col).alias("__sl_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    scored = model.transform(_with_features(table, F.col("host"), F.col("path")))
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    score = vector_to_array("__sl_probability")[1]
    return scored.select(F.col("__sl_id").alias(id_col), "host", "path", name.alias("rule"), F.coalesce(verdict, F.when(score >= threshold, "block").otherwise("allow")).alias("verdict"), score.alias("score"))
