"""Secret scans with a random forest that removes false positives.

*Candidates* are all runs of ``LEAST`` or more token characters within a word
of a text, and the values behind a credential's name and an assignment, of any
length and signs.  *Features*: length, changes of character class, shares of digits and
capitals, distinct characters, letter trigrams found in the dictionary (those
common in the corpus's own long alphabetic words), words of the path (the
source) and the words before and after.
*Labelled findings* train the forest: given ones (text key, position, label),
or findings labelled by plain rules.  Secrets are mixed characters assigned to
a credential's name, and tokens of a published credential format.  Others are
words of letters or figures only, and what is named by nothing and looks like
a digest, a UUID, a path, a version or encoded data.  Each is seen twice more
without its neighbours: as itself, which is then no secret (characters alone
don't tell a key from a digest), and as one of a published format, which is.
At most ``TRAIN_ROWS`` findings are used, the smallest by hash.
Equal scores at ``CUT`` are secrets.

DataFrame functions and Spark's own forest only.  Null and empty texts have
no findings; repeated rows have theirs each.  Without findings of both kinds
nothing is a secret but what the rules label so.  The secret itself is not
returned, but its SHA-256.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from rollwise.llm.common import beside, bind, saved, words_col

LEAST = 16
TRAIN_ROWS = 20_000
NEAR = 64
TREES, DEPTH, SEED = 30, 6, 7
CUT = 0.5
DICTIONARY_SHARE = 0.0002
#: Names of credentials, and paths and neighbours that tell examples.
NAMES = r"(?i)(token|secret|passw|pwd|api[_-]?key|apikey|access[_-]?key|private|credential|auth|bearer)"
EXAMPLES = r"(?i)(example|sample|dummy|placeholder|test|mock|fixture|doc)"
TOKEN = rf"[A-Za-z0-9+/_=.\-]{{{LEAST},}}"
#: A credential's name and an assignment; then a value in quotes, or one up to
#: white space, a quote, closing signs or the next name and assignment.
HEAD = NAMES.replace("(token", "(?:token") + r"""[\w.\-]{0,64}[\\"'`\]]{0,4}\s{0,8}(?::=|=>|={1,3}|:)\s{0,8}"""
BARE = (r"""(?:(?![,;&)}\]{\[]{1,4}["']?[\w.\-]{1,64}["']?[=:]|[,;.)}\]]{0,8}(?:\s|$))[^\s"'`])++""")
VALUES = (r"""\\+"([^"\\\n]++)\\+\"""" + r"""|"((?:[^"\\\n]|\\.)++)\"""" + r"""|'((?:[^'\\\n]|\\.)++)'|`([^`\n]++)`|["'`]?(""" + BARE + ")")
ASSIGNED = f"{HEAD}(?:{VALUES})"
MASK = "[SECRET]"
FEATURES = ("length", "changes", "digits", "capitals", "distinct", "coverage", "hexadecimal", "example_path", "named", "assigned",
            "quoted", "example_word", "format")
#: Published formats of credentials.
FORMATS = (r"^(?:A[KS]IA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_\-]{20,}|xox[abprs]-[A-Za-z0-9\-]{10,}|"
           r"AIza[0-9A-Za-z_\-]{35}|sk-[A-Za-z0-9_\-]{20,}|sk_live_[A-Za-z0-9]{16,}|"
           r"eyJ[A-Za-z0-9_\-]{8,}\.eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]+)$")
#: What mixed characters without a credential's name mostly are: digests, UUIDs, paths, versions, encoded data.
HARMLESS = (r"^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64})$|"
            r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$|/[^/]*/|[A-Za-z][._\-]v?\d+\.\d+|^.{200}")


def findings(docs: DataFrame) -> DataFrame:
    """Candidates: key (hash of the text), doc_id, source, position (word
    number), run (number in the word), token, word (the token and what stands
    close to it in its word), before, before2, after (words, their near ends).
    A value behind a name and an assignment has run -1, and for a position its
    number among those of the text."""
    return long_runs(docs).unionByName(assigned_values(docs))


def assigned_values(docs: DataFrame) -> DataFrame:
    """The values behind a credential's name and an assignment, of any length
    and signs, but those that are a long run and so a candidate already."""
    rows = docs.select(F.xxhash64("text").alias("key"), "doc_id", "source", F.regexp_extract_all("text", F.lit(ASSIGNED), F.lit(0)).alias("held"),
                       F.split("text", ASSIGNED, -1).alias("gaps")).where(F.size("held") > 0)
    rows = rows.select("key", "doc_id", "source", F.explode(F.transform("held", lambda word, k: F.struct(
        k.alias("position"), word.alias("word"), words_col(F.right(F.get("gaps", k), F.lit(2 * NEAR))).alias("left"),
        F.get(words_col(F.left(F.get("gaps", k + 1), F.lit(NEAR))), F.lit(0)).alias("after")))).alias("f"))
    rows = rows.select("key", "doc_id", "source", F.col("f.position"), F.lit(-1).alias("run"),
                       F.concat(*(F.regexp_extract("f.word", ASSIGNED, k) for k in range(1, 6))).alias("token"), F.col("f.word"),
                       F.try_element_at("f.left", F.lit(-1)).alias("before"), F.try_element_at("f.left", F.lit(-2)).alias("before2"),
                       F.col("f.after"))
    return rows.where((F.length("token") > 0) & ~(F.col("token").rlike(f"^{TOKEN}$") & ~F.contains("word", F.concat(F.lit("="), "token"))))


def long_runs(docs: DataFrame) -> DataFrame:
    """All runs of ``LEAST`` or more token characters."""

    def each(words: Column) -> Column:
        held = F.transform(words, lambda w, i: F.when((F.length(w) >= LEAST) & w.rlike(TOKEN), i))
        near = lambda i: F.right(F.when(i >= 0, F.get(words, F.greatest(i, F.lit(0)))), F.lit(NEAR))
        return F.transform(F.filter(held, lambda i: i.isNotNull()), lambda i: F.struct(
            i.alias("position"), F.get(words, i).alias("held"), near(i - 1).alias("before"), near(i - 2).alias("before2"),
            F.left(F.get(words, i + 1), F.lit(NEAR)).alias("after")))

    def runs(tokens: Column) -> Column:
        between = F.split("held", TOKEN, -1)
        return bind(between, lambda gaps: F.transform(tokens, lambda token, k: F.struct(
            k.alias("run"), token.alias("token"), F.concat(
                F.right(F.concat(F.when(k > 0, F.get(tokens, F.greatest(k - 1, F.lit(0)))).otherwise(""), F.get(gaps, k)), F.lit(NEAR)),
                token, F.left(F.get(gaps, k + 1), F.lit(NEAR))).alias("word"))))

    rows = docs.select(F.xxhash64("text").alias("key"), "doc_id", "source", F.explode(bind(words_col(F.col("text")), each)).alias("f"))
    rows = rows.select("key", "doc_id", "source", "f.*")
    rows = rows.withColumn("r", F.explode(bind(F.regexp_extract_all("held", F.lit(TOKEN), F.lit(0)), runs)))
    return rows.select("key", "doc_id", "source", "position", "r.*", "before", "before2", "after")


def _trigrams(token: Column) -> Column:
    """Codes of the a-z trigrams of a token."""
    low = F.lower(token)
    code = lambda i: F.ascii(F.substr(low, i, F.lit(1))) - 97
    letter = lambda x: (x >= 0) & (x < 26)
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(token) - 2, F.lit(1))), lambda i: F.when(
        letter(code(i)) & letter(code(i + 1)) & letter(code(i + 2)), (code(i) * 26 + code(i + 1)) * 26 + code(i + 2)))
    return F.filter(grams, lambda g: g.isNotNull())


def dictionary(found: DataFrame) -> list[int]:
    """For each a-z trigram 1 if it is common in the corpus's long words."""
    rows = (found.where(F.col("token").rlike("^[A-Za-z]+$")).select(F.explode(_trigrams(F.col("token"))).alias("g"))
            .groupBy("g").count().collect())  # 26^3 rows at most
    total, out = sum(r["count"] for r in rows), [0] * 26 ** 3
    for r in rows:
        out[r["g"]] = int(r["count"] >= DICTIONARY_SHARE * total)
    return out


def featured(found: DataFrame, known: list[int]) -> DataFrame:
    token, size = F.col("token"), F.length("token").cast("double")
    table = F.split(F.lit(",".join(map(str, known))), ",").cast("array<int>")  # folded to one literal
    share = lambda pattern: F.regexp_count(token, F.lit(pattern)) / size
    around = F.concat_ws(" ", "before2", "before", "word")
    text = F.coalesce(F.col("before"), F.lit(""))
    return found.withColumns({
        "length": size,
        "changes": share(r"(?=[a-z][^a-z])|(?=[A-Z][^A-Za-z])|(?=[0-9][^0-9])"),
        "digits": share("[0-9]"), "capitals": share("[A-Z]"),
        "distinct": F.size(F.array_distinct(F.split(token, ""))) / F.least(size, F.lit(64.0)),
        "coverage": bind(_trigrams(token), lambda g: F.when(F.size(g) > 0, F.size(F.filter(
            g, lambda x: F.get(table, x) == 1)) / F.greatest(size - 2, F.lit(1.0))).otherwise(0.0)),
        "hexadecimal": token.rlike("^[0-9a-fA-F]+$").cast("double"),
        "example_path": F.coalesce(F.col("source").rlike(EXAMPLES), F.lit(False)).cast("double"),
        "named": around.rlike(NAMES).cast("double"),
        "assigned": ((F.col("run") < 0) | text.rlike("[=:]") | F.col("word").rlike(r"[A-Za-z]\s*[=:]\s*[\"']?")).cast("double"),
        "quoted": F.col("word").rlike("[\"'`]").cast("double"),
        "example_word": F.concat_ws(" ", "before", "after").rlike(EXAMPLES).cast("double"),
        "format": token.rlike(FORMATS).cast("double")})


def rule_label() -> Column:
    """1, 0 or null (the rules don't tell) of a featured finding."""
    mixed = F.col("token").rlike("[0-9]") & F.col("token").rlike("[A-Za-z]")
    return (F.when((F.col("format") == 1) | (mixed & (F.col("named") == 1) & (F.col("assigned") == 1) & (F.col("example_word") == 0)), 1.0)
            .when((F.col("named") == 0) & F.col("token").rlike(HARMLESS), 0.0)
            .when(F.col("token").rlike(r"^[A-Za-z.\-_=+/]+$") | F.col("token").rlike(r"^[0-9.\-_=+/]+$"), 0.0))


def forest(rows: DataFrame):
    """A forest fitted on labelled featured findings, or None."""
    # Per label the smallest by hash: a top-k of each task, no label's rows in one task.
    kind = lambda label: (rows.where(F.col("label") == label).orderBy(F.xxhash64("key", "position", "run"), "key", "position", "run", "doc_id")
                          .limit(TRAIN_ROWS // 2))
    sample = saved(kind(1.0).unionByName(kind(0.0)), "findings")
    kinds = {r["label"] for r in sample.select("label").distinct().collect()}
    if len(kinds) < 2:
        return None
    bare = sample.withColumns({c: F.lit(0.0) for c in ("named", "assigned", "quoted", "example_word")})
    alone = bare.withColumns({"format": F.lit(0.0), "label": F.lit(0.0)}).unionByName(
        bare.where("label = 1").withColumn("format", F.lit(1.0)))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxBins=64).fit(
        vectors.transform(sample.unionByName(alone).select("label", *FEATURES)))


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """A row per candidate: key, doc_id, position, run, length, token_sha256, score, is_secret, token."""
    found = saved(findings(docs.select("doc_id", "text", "source")), "candidates")
    rows = featured(found, dictionary(found))
    if labelled is None:
        rows = rows.withColumn("label", rule_label())
    else:
        rows = rows.join(labelled.select("key", "position", "run", F.col("is_secret").cast("double").alias("label")),
                         ["key", "position", "run"], "left")
    rows = saved(rows, "features")
    model = forest(rows)
    if model is None:
        scored = rows.withColumn("score", F.coalesce("label", F.lit(0.0)))
    else:
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        scored = model.transform(vectors.transform(rows)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("key", "doc_id", "position", "run", F.col("length").cast("long").alias("length"),
                         F.sha2(F.col("token").cast("binary"), 256).alias("token_sha256"), F.round("score", 6).alias("score"),
                         (F.col("score") >= CUT).alias("is_secret"), "token")


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in text replaced by ``MASK``; no row goes."""
    return beside(docs, _masked)


def _masked(docs: DataFrame) -> DataFrame:
    long_first = lambda name: F.array_sort(name, lambda a, b: F.length(b) - F.length(a))
    of = lambda run: F.collect_set(F.when(run, F.col("token")))
    secrets = (scan(docs).where("is_secret").groupBy("key").agg(of(F.col("run") >= 0).alias("_tokens"), of(F.col("run") < 0).alias("_values"))
               .withColumns({"_tokens": long_first("_tokens"), "_values": long_first("_values")}))
    # A value goes where it stands behind a name: a short one may be a word elsewhere.
    behind = lambda v: F.concat(F.lit(rf"""({HEAD}(?:\\+"|["'`])?)\Q"""), F.replace(v, F.lit("\\E"), F.lit(r"\E\\E\Q")),
                                F.lit(r"""\E(?=\\?["'`]|[,;&.)}\]{\[\s]|$)"""))
    text = F.aggregate("_values", F.col("text"), lambda t, v: F.regexp_replace(t, behind(v), F.lit(f"$1{MASK}")))
    text = F.aggregate("_tokens", text, lambda t, s: F.replace(t, s, F.lit(MASK)))
    out = docs.withColumn("_key", F.xxhash64("text")).join(secrets.withColumnRenamed("key", "_key"), "_key", "left")
    out = out.withColumn("text", F.when(F.col("_tokens").isNull(), F.col("text")).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_tokens").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*docs.columns)
