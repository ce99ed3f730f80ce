"""Secret scans: patterns find candidates, a random forest drops false ones.

Candidates are found with one regular expression. Each is described by its
length, its shares of character classes and class changes, how much of it is
covered by dictionary words, the path (source) of its document and the words
on both sides; a random forest trained on a labelled table of findings decides
whether it is a secret. All of it runs in the JVM on DataFrame functions; the
forest is of fixed size.

Texts without a candidate are left after one match test. Null and empty texts
have no candidates; an empty table gives an empty result. Repeated rows, and
rows of one id, are scanned one by one. Texts of any length are scanned whole;
the candidates of one text, not more than a tenth of its characters, are put
in order in one task for their context. ``source`` counts as the path where it
is there; extra columns, whatever their names, aren't read by ``scan`` and pass
through ``redact`` untouched.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize

#: A private key reaches to its END, whatever lies between; another BEGIN or END
#: ends the search. Without END it reaches over all lines of key characters that
#: follow (16 or more of them without a space; quotes and escaped ends of lines
#: may part them) and a shorter last one. Loops are possessive: no depth, no
#: second try, so no bound on their number.
_PARTED = r"(?:[\s>#\"',|]|\\[nr])++"
_TO_END = r"[^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+-----END [A-Z ]*PRIVATE KEY-----"
_TO_LAST_LINE = rf"(?:{_PARTED}(?:Proc-Type: ?[0-9]+,[A-Z]++|DEK-Info: ?[0-9A-Z-]+,[0-9A-Fa-f]++))*+(?:(?:{_PARTED}[0-9A-Za-z+/=_-]{{16,}}+)++(?:{_PARTED}(?=[A-Za-z_-]*+[0-9=+/])[0-9A-Za-z+/=_-]++|[\r\n]++[ \t]*+[0-9A-Za-z+/=_-]++(?=[ \t]*+(?![^\r\n])))?+)?+"

#: Kinds of candidates: (kind, pattern). Formats are the public ones.
KINDS = (
    ("aws_key", r"(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])"),
    ("github_token", r"gh[pousr]_[0-9A-Za-z]{36}"),
    ("slack_token", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
    ("live_key", r"[sr]k_live_[0-9A-Za-z]{16,}"),
    ("google_key", r"AIza[0-9A-Za-z_-]{35}"),
    ("jwt", r"eyJ[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}"),
    ("private_key", rf"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:{_TO_END}|{_TO_LAST_LINE})"),
    ("assignment", r"""(?i:password|passwd|pwd|secret|token|api_?key|credentials?|auth|private|login|key)["']?\s{0,3}[=:]\s{0,3}["']?[^\s"'<>]{6,}"""),
    ("long_string", r"(?<![0-9A-Za-z+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[0-9A-Za-z+/_=-]{32,}"),
)
PATTERN = "|".join(f"(?:{p})" for _, p in KINDS)
_ASSIGNED = r"""^(?:[A-Za-z_]{3,11})["']?\s{0,3}[=:]\s{0,3}["']?"""

#: Placeholders that a real secret would hardly contain.
PLACEHOLDERS = ("example", "changeme", "password", "secret", "token", "test", "dummy", "sample", "placeholder", "your", "xxxx", "admin", "user", "none", "null", "true", "false", "value", "string", "demo", "fake", "redacted", "insert", "here", "abcdef", "123456", "hello", "world", "commit", "sha256", "image", "data")
#: Frequent words of four letters or more, of code and of the
#: languages at hand.
FREQUENT = tuple(
    """request header config file path name default environ process system class element index type return count
    service client server session cookie object array number field model input output

    that this with from have they which there their would about could other people because before between through
    should think after first water where little year every great small found still good under school line house page

    dans pour avec cette comme tout mais plus leur bien fait nous vous sont elle deux aussi autre sans entre encore temps

    nicht eine sich auch werden aber noch wird sind oder haben nach kann durch wenn zeit jahr mehr unter welt immer

    para pero este esta cuando sobre hasta donde quien desde todos durante otro parte mundo siempre tiempo""".split()
)
DICTIONARY = (*PLACEHOLDERS, *FREQUENT)
_WORD = "(?i)(" + "|".join(sorted(DICTIONARY, key=len, reverse=True)) + ")"
_SECRET_WORDS = r"(?i)(password|passwd|pwd|secret|token|api_?key|credential|auth|private|login|key)"
_BENIGN_WORDS = r"(?i)(commit|checksum|sha-?1|sha-?256|md5|digest|uuid|guid|hash|etag|integrity|example|revision|base64|fixture|placeholder|blob|isbn|invoice|order)"
FEATURES = ("f_length", "f_digits", "f_upper", "f_lower", "f_changes", "f_repeats", "f_hex", "f_words", "f_path", "f_near_secret", "f_near_benign", "f_quoted", *(f"f_{k}" for k, _ in KINDS))
CONTEXT, NEAR = 48, 5
THRESHOLD = 0.5


def kind_of(candidate: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(KINDS):
        out = F.when(candidate.rlike("^(?:" + pattern + ")"), kind).otherwise(out)
    return out


def _share(value: Column, drop: str) -> Column:
    """Share of ``value`` that the class ``drop`` covers."""
    return (F.length(value) - F.length(F.regexp_replace(value, drop, ""))) / F.greatest(F.length(value), F.lit(1))


def with_features(found: DataFrame) -> DataFrame:
    """Adds FEATURES to ``candidate, left, right, path``."""
    value = F.regexp_replace("candidate", _ASSIGNED, "")
    changes = F.length(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[0-9]+", "0"), "[A-Z]+", "A"), "[a-z]+", "a"), "[^0Aa]+", "_"))
    near = F.concat_ws(" ", "left", F.regexp_extract("candidate", _ASSIGNED, 0), "right")
    kind = kind_of(F.col("candidate"))
    columns = {
        "f_length": F.length(value),
        "f_digits": _share(value, "[0-9]"),
        "f_upper": _share(value, "[A-Z]"),
        "f_lower": _share(value, "[a-z]"),
        "f_changes": changes / F.greatest(F.length(value), F.lit(1)),
        "f_repeats": _share(value, r"(.)(?=\1)"),
        "f_hex": value.rlike("^[0-9a-fA-F-]+$"),
        "f_words": _share(value, _WORD),
        "f_path": F.coalesce(F.col("path"), F.lit("")).rlike(r"(?i)(test|example|sample|fixture|mock|docs?/)"),
        "f_near_secret": near.rlike(_SECRET_WORDS),
        "f_near_benign": near.rlike(_BENIGN_WORDS),
        "f_quoted": F.col("right").rlike("^[\"']"),
    } | {f"f_{k}": F.coalesce(kind == k, F.lit(False)) for k, _ in KINDS}
    return found.withColumn("kind", kind).withColumns({k: c.cast("double") for k, c in columns.items()})


def labelled_findings(spark: SparkSession, rows: int = 1800, first: int = 0) -> DataFrame:
    """The labelled table, made by rule from the numbers from ``first`` on:
    ``candidate, left, right, path, label`` (1: a secret), more than half of
    them look-alikes."""
    base = spark.range(first, first + rows, numPartitions=1)
    sha = F.sha2(F.col("id").cast("string"), 512)
    hexed = lambda n, at=1: F.substring(sha, at, n)
    upper = F.upper(F.translate(F.base64(F.unhex(sha)), "+/=abcdefghijklmnopqrstuvwxyz", "Q7ZABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    mixed = F.translate(F.base64(F.unhex(sha)), "+/=", "xY9")
    some = lambda k: F.element_at(F.array(*[F.lit(w) for w in DICTIONARY]), (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(DICTIONARY))) + 1).cast("int"))
    word, second, third = some(2), some(3), some(4)
    plain = F.element_at(F.array(*[F.lit(w) for w in ("the value of ", "und der ", "les mots ", "set to ", "", "we saw ", "de la ")]), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(7)) + 1).cast("int"))
    later = F.when(F.pmod("id", F.lit(3)) == 1, " in commit ").when(F.pmod("id", F.lit(3)) == 2, " for example ").otherwise(" then")
    kinds = (
        (1, F.concat(F.lit("AKIA"), F.substring(upper, 1, 16)), plain, F.lit(" and")),
        (1, F.concat(F.lit("password="), hexed(18)), plain, later),
        (1, F.concat(F.lit('token = "'), hexed(40)), plain, F.lit('" next')),
        (1, F.concat(F.lit("ghp_"), F.substring(mixed, 1, 36)), plain, F.lit(" .")),
        (1, F.concat(F.lit("sk_live_"), F.substring(mixed, 1, 24)), plain, F.lit("")),
        (1, F.concat(F.lit("api_key: "), F.substring(mixed, 1, 32)), F.lit("config "), F.lit(" .")),
        (1, F.concat(F.lit("secret="), F.substring(mixed, 3, 20)), plain, later),
        (1, F.concat(F.lit("eyJ"), F.substring(mixed, 1, 20), F.lit("."), F.substring(mixed, 21, 30), F.lit("."), F.substring(mixed, 11, 40)), F.lit("auth bearer "), F.lit("")),
        (1, F.lit("-----BEGIN RSA PRIVATE KEY-----"), plain, F.lit(" MIIE")),
        (1, F.substring(mixed, 1, 44), F.lit("private login key "), F.lit(" ok")),
        (1, F.concat(F.lit("-----BEGIN PRIVATE KEY-----\n"), mixed, F.lit("\n"), F.reverse(mixed), F.lit("\n"), F.substring(mixed, 9, 30), F.lit("==\n-----END PRIVATE KEY-----")), plain, F.lit(" ")),
        (0, F.concat(F.lit("password="), word, F.lit("changeme")), plain, F.lit(" then")),
        (0, hexed(40), F.lit("in commit "), F.lit(" we fix")),
        (0, hexed(64), F.lit("checksum sha256 "), F.lit(" file")),
        (0, hexed(32), F.lit("md5 digest "), F.lit("")),
        (0, F.concat(hexed(8), F.lit("-"), hexed(4, 9), F.lit("-"), hexed(4, 13), F.lit("-"), hexed(4, 17), F.lit("-"), hexed(12, 21)), F.lit("uuid "), F.lit(" row")),
        (0, F.concat(F.lit("AKIA"), F.lit("IOSFODNN7EXAMPLE")), F.lit("for example "), F.lit(" here")),
        (0, F.concat(F.lit("token: "), word, word), plain, F.lit(" .")),
        (0, F.concat(F.lit("secret="), F.repeat(F.lit("x"), 12)), F.lit("placeholder "), F.lit("")),
        (0, F.concat(F.lit("api_key="), F.lit("YOUR_"), F.upper(word)), plain, F.lit(" .")),
        (0, F.concat(F.repeat(F.lit("-=_"), 13), F.lit("0")), plain, F.lit(" ")),
        (0, F.concat(word, F.lit("_"), word, F.lit("_long_identifier_name_"), hexed(2)), plain, F.lit(" ")),
        (0, F.concat(F.lit("token = "), word, F.lit("_count")), plain, F.lit(" ")),
        (0, F.concat(F.lit("token = "), word, F.lit("."), second, F.lit("["), third, F.lit("]")), plain, F.lit(" ")),
        (0, F.concat(F.lit("password=${"), F.upper(word), F.lit("_"), F.upper(second), F.lit("}")), plain, F.lit(" ")),
        (0, F.concat(F.lit("login: "), word, F.lit("."), second, F.lit("@"), third, F.lit(".com")), plain, F.lit(" ")),
        (0, F.concat(F.lit("key="), word, F.lit("-"), second, F.lit("-"), third), plain, F.lit(" ")),
        (0, F.concat(F.lit("iVBORw0KGgo"), F.substring(mixed, 1, 60)), F.lit("data:image/png;base64,"), F.lit("")),
        (0, F.concat(F.lit("sha512-"), F.substring(mixed, 1, 86), F.lit("==")), F.lit("integrity: "), F.lit("")),
        (0, F.concat(F.lit("2024/05/"), word, F.lit("/"), second, F.lit("-"), third, F.lit("-"), word, F.lit("-and-"), second), plain, F.lit("")),
        (0, F.concat(F.initcap(word), F.initcap(second), F.initcap(third), F.lit("2"), F.initcap(word), F.initcap(second), F.lit("Of"), F.initcap(third)), plain, F.lit("(")),
        (0, F.translate(F.substring(sha, 1, 34), "abcdef", "123456"), F.lit("order no "), F.lit(" ")),
        (1, F.concat(F.lit("pwd: "), F.substring(mixed, 5, 12)), plain, F.lit(" ")),
        (1, F.concat(F.lit("login="), hexed(10), F.lit("!"), F.substring(mixed, 2, 6)), plain, F.lit(" ")),
        (1, F.concat(F.lit("credential="), F.substring(mixed, 9, 28)), plain, later),
    )
    pick = F.pmod(F.col("id"), F.lit(len(kinds)))
    choose = lambda k: F.coalesce(*[F.when(pick == i, x[k] if isinstance(x[k], Column) else F.lit(x[k])) for i, x in enumerate(kinds)])
    path = F.when(pick == 16, "docs/readme.md").when((pick >= 11) & (F.pmod(F.col("id"), F.lit(3)) == 0), "tests/fixture.txt").otherwise(F.concat(F.lit("src"), F.pmod(F.col("id"), F.lit(20))))
    return base.select(choose(1).alias("candidate"), choose(2).alias("left"), choose(3).alias("right"), path.alias("path"), choose(0).cast("double").alias("label"))


def fit(labelled: DataFrame) -> RandomForestClassificationModel:
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(with_features(labelled))
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=30, maxDepth=8, seed=7, probabilityCol="probability", rawPredictionCol="raw", predictionCol="prediction")
    return forest.fit(table.select("features", "label").coalesce(1))


def candidates(docs: DataFrame, keys: tuple[str, ...], text: str = "text", path: str | None = "source") -> DataFrame:
    """One row per candidate: ``keys, position`` (characters before it, from
    0), ``candidate, left, right, path``."""
    body, n = F.col(text), F.size("__sl_found")
    source = F.col(path).cast("string") if path and path in docs.columns else F.lit(None).cast("string")
    some = docs.withColumn("__sl_line", F.monotonically_increasing_id()).where(body.rlike(PATTERN)).select(*keys, "__sl_line", source.alias("path"), F.regexp_extract_all(body, F.lit(PATTERN), F.lit(0)).alias("__sl_found"), F.split(body, PATTERN, -1).alias("__sl_rest"))
    zipped = F.arrays_zip("__sl_found", F.slice("__sl_rest", F.lit(1), n).alias("before"), F.slice("__sl_rest", F.lit(2), n).alias("after"))
    short = F.transform(zipped, lambda x: F.struct(x["__sl_found"].alias("candidate"), F.right(x["before"], F.lit(CONTEXT)).alias("before"), F.left(x["after"], F.lit(CONTEXT)).alias("after"), F.length(x["before"]).cast("long").alias("gap")))
    spread = some.select(*keys, "__sl_line", "path", F.posexplode(short).alias("__sl_i", "__sl_x")).select(*keys, "__sl_line", "path", "__sl_i", "__sl_x.*")
    # characters up to the end of this candidate, less its own; a window holds one document's candidates
    line = Window.partitionBy("__sl_line").orderBy("__sl_i")
    reach = F.sum(F.col("gap") + F.length("candidate")).over(line)
    # a candidate has 10 characters at least, so NEAR of them with their gaps fill the context
    earlier = F.array_join(F.collect_list(F.concat("before", F.right("candidate", F.lit(CONTEXT)))).over(line.rowsBetween(-NEAR, -1)), "")
    later = F.array_join(F.collect_list(F.concat(F.left("candidate", F.lit(CONTEXT)), "after")).over(line.rowsBetween(1, NEAR)), "")
    left, right = F.right(F.concat(earlier, "before"), F.lit(CONTEXT)), F.left(F.concat("after", later), F.lit(CONTEXT))
    return spread.select(*keys, (reach - F.length("candidate")).alias("position"), "candidate", left.alias("left"), right.alias("right"), "path")


def scan(docs: DataFrame, model: RandomForestClassificationModel, keys: tuple[str, ...] = ("doc_id",), text: str = "text", path: str | None = "source", threshold: float = THRESHOLD) -> DataFrame:
    """One row per candidate: ``keys, position, kind, candidate, probability,
    is_secret``."""
    table = VectorAssembler(inputCols=list(FEATURES), outputCol="__sl_features").transform(with_features(candidates(docs, keys, text, path)))
    scored = model.setFeaturesCol("__sl_features").transform(table)
    chance = vector_to_array("probability")[1]
    return scored.select(*keys, "position", "kind", "candidate", chance.alias("probability"), (chance >= threshold).alias("is_secret"))


def redact(docs: DataFrame, model: RandomForestClassificationModel, text: str = "text", path: str | None = "source", mark: str = "[SECRET]", chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with every secret's value replaced by ``mark`` (an
    assignment keeps its name); ``chars``, where it is there, counts anew.

    Longer values are replaced first, as they may hold shorter ones.
    Only texts that hold a candidate are written once, hashed and joined with the
    secrets found in them, and only they may be shuffled for that; all others are
    passed on as they are. Copies of a text are cleaned alike.
    """
    own = "__sl_hash"
    some = F.coalesce(F.col(text).rlike(PATTERN), F.lit(False))
    hashed = materialize(docs.where(some), "candidates").withColumn(own, F.sha2(F.col(text), 256))
    found = scan(hashed, model, (own,), text, path).where("is_secret")
    value = F.regexp_replace("candidate", _ASSIGNED, "")
    lists = materialize(found.select(own, value.alias("value")).distinct().groupBy(own).agg(F.transform(F.sort_array(F.collect_set(F.struct(F.length("value").alias("n"), "value")), asc=False), lambda x: x["value"]).alias("__sl_values")), "secrets")
    cleaned = F.aggregate(F.coalesce("__sl_values", F.array().cast("array<string>")), F.col(text), lambda acc, v: F.replace(acc, v, F.lit(mark)))
    joined = hashed.join(lists, own, "left")
    out = {text: cleaned}
    if chars and chars in docs.columns:
        out[chars] = F.when(F.col("__sl_values").isNull(), F.col(chars)).otherwise(F.length(cleaned).cast(docs.schema[chars].dataType))
    return joined.select(*[out.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns]).unionByName(docs.where(~some))
