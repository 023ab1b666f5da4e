"""Secret scan: candidate strings by pattern, false positives removed by a random forest, in built-in functions only.

The forest looks at a candidate's length, its changes between character kinds, how much of it common letter groups cover, path
signs and the words beside it. It is trained from labelled findings: a fixed number of them, made here by hashing row
numbers into keys, tokens and passwords (secret) and digests, paths, words, identifiers and placeholders (not).

Candidates are known forms wherever they start, what is assigned to a name with a secret word (six characters or more),
and other runs of 16 characters or more. A name before '=' or ':' is never part of the candidate.

Null or empty text has no candidates. Unbroken runs of any length are one candidate. Rows are independent; repeated rows are each reported; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .native import match_places

#: Forms that tell by themselves where a secret starts, wherever they stand.
KNOWN = (
    r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])|eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+(?:[.][A-Za-z0-9_-]*)?"
    r"|(?:gh[pousr]_|github_pat_|xox[abprs]-|sk-)[A-Za-z0-9+/_-]{15,}[A-Za-z0-9+/_]"
)
SECRET_WORD = r"(?i:token|secret|passw|pwd|api.?key|(?:access|aws|signing|encryption).?key|auth(?!ors?\b)|credential|private|bearer)"
#: Of any length and with other signs: what is assigned to a name with a secret word in it. In quotes, up to the quote.
ASSIGNED = (
    rf"(?<=[=:>]\s{{0,2}}[\"']?)(?<={SECRET_WORD}[\w-]{{0,20}}[\"']?\s{{0,2}}(?::=|=>|[=:])\s{{0,2}}[\"']?)(?!(?i:bearer|basic)\s)"
    r"(?:(?<=[\"'])[^\s\"']{6,}(?=[\"'])"
    r"|[A-Za-z0-9+/_~!@#$%^*][A-Za-z0-9+/_~!@#$%^*.:?|-]{4,}[A-Za-z0-9+/_~!@#$%^*-](?:={1,2}(?![A-Za-z0-9+/_=~]))?)"
)
#: A long run: '=' is padding at its end, never between a name and its value; a known form inside starts on its own. The loop
#: is possessive, which the matcher runs without a frame per character; up to nine dots or dashes may follow one another.
RUN = (
    rf"(?<![A-Za-z0-9+/_~])[A-Za-z0-9+/_~](?:[A-Za-z0-9]|[+/_~](?!{KNOWN})|[.-](?=[.-]{{0,8}}[A-Za-z0-9+/_~])(?!{KNOWN})){{15,}}+"
    r"(?:={1,2}(?![A-Za-z0-9+/_=~.-]))?"
)
CANDIDATE = rf"-----BEGIN [A-Z ]*PRIVATE KEY-----|(?<![A-Za-z0-9])(?:{KNOWN})|{ASSIGNED}|{RUN}"
LABELLED = 6_000
TREES, DEPTH = 40, 8

#: Letter groups that make up ordinary words; what they cover of a string speaks against a secret.
GROUPS = (
    "tion|ment|ness|able|ible|ing|the|and|ent|ion|est|ers|ter|ati|ver|con|pro|com|ous|ive|ful|ure|age|ate|ist|ism|"
    "ung|sch|ein|ich|keit|heit|eau|eux|elle|que|oi|ou|ci|th|er|on|an|re|he|in|ed|nd|ha|at|en|es|of|or|nt|ea|ti|to|it|st|io|le|is|"
    "ar|as|te|me|de|co|ro|li|ri|ra|si|al|se|ne"
)
FEATURE_NAMES = (
    "length digits capitals hexadecimal changes covered vowels slashes dots extension known assigned quoted secret_word harmless_word repeats symbols named"
).split()


def features(value: Column, before: Column, after: Column) -> dict[str, Column]:
    n = F.length(value).cast("double")
    part = lambda pattern: F.regexp_count(value, F.lit(pattern)) / n
    runs = value
    for pattern, sign in (("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "0")):
        runs = F.regexp_replace(runs, pattern, sign)
    left = F.length(F.regexp_replace(F.lower(value), GROUPS, ""))
    flag = lambda c: c.cast("double")
    return {
        "length": n,
        "digits": part("[0-9]"),
        "capitals": part("[A-Z]"),
        "hexadecimal": part("[0-9a-fA-F]"),
        "changes": F.length(runs) / n,
        "covered": 1 - left / n,
        "vowels": part("[aeiouAEIOU]"),
        "slashes": F.regexp_count(value, F.lit("/")).cast("double"),
        "dots": F.regexp_count(value, F.lit("[.]")).cast("double"),
        "extension": flag(value.rlike(r"[.][a-z]{1,4}$")),
        "known": flag(value.rlike("^(?:AKIA[0-9A-Z]{16}$|gh[pousr]_|github_pat_|xox[abprs]-|sk-|eyJ[A-Za-z0-9_-]+[.]eyJ|-----BEGIN)")),
        "assigned": flag(before.rlike("[=:]\\s*[\"']?$")),
        "quoted": flag(before.rlike("[\"']$") & after.rlike("^[\"']")),
        "secret_word": flag(before.rlike(SECRET_WORD)),
        "harmless_word": flag(before.rlike("(?i)sha.?[0-9]|md5|hash|commit|digest|checksum|uuid|example|sample|dummy|path|file|url")),
        "repeats": flag(value.rlike(r"(.)\1{5}|(?i)your|change.?me|example|placeholder|xxxx")),
        "symbols": part("[^A-Za-z0-9]"),
        "named": flag(after.rlike(r"^[\"']?\s*[=:(]")),
    }


def labelled_findings(spark: SparkSession, n: int = LABELLED) -> DataFrame:
    """Columns value, before, after and label."""
    rows = spark.range(n, numPartitions=1)
    h = lambda salt: F.sha2(F.concat_ws("-", F.col("id").cast("string"), F.lit(salt)), 256)
    pick = lambda salt, items: F.element_at(
        F.array(*map(F.lit, items)), (F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(items))) + 1).cast("int")
    )
    b64 = F.regexp_replace(F.base64(F.unhex(h("b"))), "[=\r\n]", "")
    syllables = ["th", "er", "ing", "sch", "ung", "tion", "an", "re", "eau", "elle", "ent", "ion", "ou", "ver", "lich", "ado"]
    long_word = F.concat(*(pick(f"w{k}", syllables) for k in range(8)))
    words = ["lib", "src", "data", "home", "local", "share", "images", "docs", "config", "module"]
    path = F.concat(F.lit("/"), F.concat_ws("/", *(pick(f"p{k}", words) for k in range(5))), pick("x", [".py", ".txt", ".html", ""]))
    secret_before = ['token = "', "token = ", 'api_key: "', "password=", "Authorization: Bearer ", 'secret_key = "', "auth = '", "TOKEN = \""]
    secret_before += ["API_KEY=", "--token=", "https://example.net/x?api_key=", 'password": "', "export SECRET=", "password: ", "pwd='"]
    plain_before = ["in the ", "see ", "of ", "and, ", "commit ", "sha256: ", "md5 = ", "checksum: ", "file ", "digest = \"", "url: ", "uuid="]
    prose_before = ["in the ", "see ", "of ", "and, ", "", "it was (", "\n", "x = ", "key=", 'id: "', "-", "..."]
    hash_before = ["sha256-", "integrity=\"sha512-", "digest: ", "checksum = ", "md5: ", "hash '"]
    earlier = pick("e", ["", "", "", "in the file\n", "DB_URL=x\n"])
    uuid = F.concat_ws("-", *(F.substring(h("u"), a, b) for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    filler = pick("f", ["x" * 24, "your_api_key_here_please", "EXAMPLEEXAMPLEEXAMPLE", "changeme-changeme-changeme", "0" * 32, "a" * 20])
    short = F.concat(F.substring(b64, 5, 4), pick("s", ["", "!", "#", "$", "@", "-"]), F.substring(b64, 21, 4), pick("t", ["7", "q2", "X9k", "4Tz!"]))
    letters = F.concat(F.translate(F.substring(h("l"), 1, 26), "0123456789", "ghijklmnop"), F.substring(h("l"), 30, 8))
    body = F.when(pick("v", [True, False]), F.substring(b64, 3, 36)).otherwise(letters)
    jwt = F.concat(F.lit("eyJ"), F.substring(b64, 1, 17), F.lit(".eyJ"), F.substring(b64, 9, 24), F.lit("."), F.substring(b64, 2, 40))
    names = ["access", "token", "secret", "user", "get", "default", "key", "client", "password", "request", "config", "auth", "value", "from"]
    parts = [pick(f"n{k}", names) for k in range(4)]
    name = F.concat_ws("_", *parts)
    name = F.replace(name, F.lit("_"), pick("j", ["_", "_", "_", ".", "-", "/"]))
    name = F.when(pick("d", [True, False, False]), F.upper(name)).otherwise(name)
    camel = F.concat(parts[0], *map(F.initcap, parts[1:]), pick("m", ["", "2", "Header"]))
    word = F.concat(*(pick(f"w{k}", syllables) for k in range(3)))
    common = ["required", "undefined", "settings", "password", "string", "request.user", "optional", "hidden", "Beschreibung", "nothing"]
    word = F.when(pick("o", [True, False]), pick("q", common)).otherwise(word)
    word = F.when(pick("i", [True, False, False]), F.initcap(word)).otherwise(word)
    kinds = [  # what stands in the text, what may stand before it, label
        (F.substring(h("a"), 1, 40), secret_before, 1),
        (F.substring(b64, 1, 32), secret_before, 1),
        (F.concat(F.lit("AKIA"), F.upper(F.substring(h("k"), 1, 16))), secret_before + prose_before, 1),
        (F.concat(pick("g", ["ghp_", "xoxb-", "sk-"]), body), secret_before + prose_before, 1),
        (F.upper(F.substring(h("c"), 1, 40)), secret_before, 1),
        (short, secret_before, 1),
        (jwt, secret_before + prose_before, 1),
        (F.substring(b64, 4, 36), prose_before, 1),
        (F.substring(h("d"), 1, 40), plain_before, 0),
        (long_word, plain_before, 0),
        (path, plain_before, 0),
        (uuid, plain_before, 0),
        (filler, secret_before, 0),
        (name, secret_before + plain_before + prose_before, 0),
        (word, secret_before, 0),
        (b64, hash_before, 0),
        (camel, secret_before + plain_before + prose_before, 0),
    ]
    kind = F.pmod(F.col("id"), F.lit(len(kinds))).cast("int")
    of = lambda items: F.element_at(F.array(*items), kind + 1)
    value, label = of([k[0] for k in kinds]), of([F.lit(float(k[2])) for k in kinds])
    before = F.concat(earlier, of([pick(f"b{k}", x[1]) for k, x in enumerate(kinds)]))
    after = F.when(before.endswith('"'), F.lit('" ')).when(before.endswith("'"), F.lit("' "))
    after = F.when(of([F.lit(k[0] is name) for k in kinds]), pick("a", ["=x", " =", ": ", "()"])).otherwise(F.coalesce(after, pick("a", [" ", "\n", ". "])))
    return rows.select(value.alias("value"), before.alias("before"), after.alias("after"), label.alias("label"))


def _assembled(df: DataFrame) -> DataFrame:
    df = df.withColumns(features(F.col("value"), F.col("before"), F.col("after")))
    return VectorAssembler(inputCols=FEATURE_NAMES, outputCol="features", handleInvalid="keep").transform(df)


def trained(spark: SparkSession) -> RandomForestClassificationModel:
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=3, featureSubsetStrategy="sqrt")
    return forest.fit(_assembled(labelled_findings(spark)).select("features", "label"))


def secret_scan(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, n_candidates, n_secrets, spans (secret:start:end, in code points), score (the highest)."""
    model = trained(docs.sparkSession)
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    found = F.when(F.col("text").rlike(CANDIDATE), match_places(F.col("text"), CANDIDATE))
    found = F.transform(
        found,
        lambda m: F.struct(
            m["at"].alias("at"),
            m["value"].alias("value"),
            F.substring(F.col("text"), F.greatest(m["at"] - 39, F.lit(1)), F.least(m["at"], F.lit(40))).alias("before"),
            F.substring(F.col("text"), m["at"] + F.length(m["value"]) + 1, F.lit(2)).alias("after"),
        ),
    )
    rows = rows.select("doc_id", "row", F.inline_outer(found))
    scored = model.transform(_assembled(rows)).withColumn("p", vector_to_array("probability")[1])
    span = F.struct("at", F.concat(F.lit("secret:"), "at", F.lit(":"), F.col("at") + F.length("value")).alias("span"))
    scored = scored.select("doc_id", "row", "value", "p", F.when(F.col("value").isNotNull() & (F.col("p") >= threshold), span).alias("hit"))
    out = scored.groupBy("doc_id", "row").agg(
        F.count("value").alias("n_candidates"),
        F.count("hit").alias("n_secrets"),
        F.concat_ws(",", F.transform(F.array_sort(F.collect_list("hit")), lambda s: s["span"])).alias("spans"),
        F.coalesce(F.max(F.when(F.col("value").isNotNull(), F.col("p"))), F.lit(0.0)).alias("score"),
    )
    return out.drop("row")
