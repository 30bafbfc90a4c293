"""Secret scan with multipart credential linking, in DataFrame functions only.

Strong kinds are reported wherever they stand: ``assign`` (a secret's name, a
separator and a value of 6 characters or more), ``access`` (an access key
identifier of 20 or more) and ``hex`` (24 or more hexadecimal digits).  Weak
kinds are ``ident`` (other account or key identifiers), ``blob`` (20 or more
mixed letters and digits) and ``endpoint`` (a URL with a scheme).  A weak
candidate is reported only where complementary parts stand in its scope (the
text between two blank lines) and within ``REACH`` characters: an identifier
with a secret, a secret with an identifier, an endpoint with both.  The link is
an interval join on (row, scope, position bin).

Positions are code points, end exclusive.  They come from the lengths of the
matches and of the text between them, summed over a window per row and kind, so
no text is shuffled.  Null texts count as empty; repeated rows and doc_ids each
keep a row of their own; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from domus.llm.common import id_and_text, materialise, table

REACH = 400
MASK = "[SECRET]"

# fixed values: the base patterns
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"

IDENT = (r"(?<![A-Za-z0-9])(?:(?:ASIA|AIDA|AROA|AGPA)[A-Z0-9]{12,}"
         r"""|(?i:user|username|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,})""")
BLOB = (r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*+[0-9])(?=[A-Z0-9+/_-]*+[a-z])(?=[a-z0-9+/_-]*+[A-Z])[A-Za-z0-9+/_-]{20,}+")
ENDPOINT = r"""(?<![A-Za-z0-9])(?i:https?|jdbc:[a-z0-9]+|ftp|postgres|postgresql|mysql|mongodb|redis|amqp)://[^\x00-\x20"'<>\\]+"""
BREAK = r"\n[\x20\t\r]*\n"

#: kind, pattern, whether a text can hold one (a cheap test), and the order in which kinds are listed
KINDS = [
    ("assign", ASSIGN, lambda t: _any(F.lower(t), "password", "passwd", "secret", "token", "apikey", "api_key")),
    ("access", r"AKIA[A-Z0-9]{16,}", lambda t: t.contains("AKIA")),  # shorter ones fail whole, so they hide none
    ("hex", r"[0-9a-f]{24,}", lambda t: t.rlike(r"[0-9a-f]{24}")),  # matches are whole runs
    ("ident", IDENT, lambda t: _any(F.lower(t), "user", "login", "account", "client", "access") | _any(t, "ASIA", "AIDA", "AROA", "AGPA")),
    ("blob", BLOB, lambda t: t.rlike(BLOB)),
    ("endpoint", ENDPOINT, lambda t: t.contains("://")),
    ("break", BREAK, lambda t: t.contains("\n")),
]
STRONG = ["assign", "access", "hex"]
WEAK = ["ident", "blob", "endpoint"]
ORDER = {k: i for i, (k, _, _) in enumerate(KINDS)}


def _any(text, *words):
    out = text.contains(words[0])
    for w in words[1:]:
        out = out | text.contains(w)
    return out


def _matches(text, kind: str, pattern: str):
    """Array of (kind, at, gap, len, ok): the match's number, the characters
    since the match before, its length and whether it passes the kind's test."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if kind == "assign" else None
    rows = F.transform(found, lambda m, i: F.struct(
        F.lit(ORDER[kind]).alias("kind"), i.alias("at"), F.length(gaps[i]).alias("gap"), F.length(m).alias("len"),
        (F.length(value[i]) >= 6 if value is not None else F.lit(True)).alias("ok")))
    return rows


_PART = "array<struct<kind:int,at:int,gap:int,len:int,ok:boolean>>"


def find_parts(docs: DataFrame) -> DataFrame:
    """(row, doc_id, hash, kind, start, end, scope): every strong and weak part; a
    document without any has only rows with null kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast(_PART)
    base = id_and_text(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("hash"), text.alias("text"))
    arrays = [F.when(test(F.col("text")), _matches(F.col("text"), k, p).cast(_PART)).otherwise(none) for k, p, test in KINDS if k != "break"]
    rows = base.withColumn("parts", F.concat(*arrays))
    weak = F.exists("parts", lambda x: x["kind"].isin([ORDER[k] for k in WEAK]))
    breaks = F.when(weak & F.col("text").contains("\n"), _matches(F.col("text"), "break", BREAK).cast(_PART)).otherwise(none)
    rows = rows.select("row", "doc_id", "hash", F.explode_outer(F.concat("parts", breaks)).alias("p")).select("row", "doc_id", "hash", "p.*")
    w = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the end of a match is the sum of all gaps and matches up to it
    rows = rows.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("len")).over(w))
    rows = rows.withColumn("start", F.col("end") - F.col("len"))
    scope = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("scope", F.coalesce(F.sum((F.col("kind") == ORDER["break"]).cast("int")).over(scope), F.lit(0)))
    # a row all of whose matches fail must not vanish
    real = F.col("ok") & (F.col("kind") != ORDER["break"])
    return rows.select("row", "doc_id", "hash", *[F.when(real, F.col(c)).alias(c) for c in ("kind", "start", "end")],
                       F.col("scope").cast("long").alias("scope"))


def link_parts(parts: DataFrame) -> DataFrame:
    """The weak parts (row, doc_id, hash, kind, start, end) whose complement stands in
    their scope within REACH: interval joins by position bin."""
    here = parts.filter(F.col("kind").isNotNull())
    weak = here.filter(F.col("kind").isin([ORDER[k] for k in WEAK])).withColumn("bin", F.floor(F.col("start") / REACH))
    idents, secrets = [ORDER["access"], ORDER["ident"]], [ORDER["assign"], ORDER["hex"], ORDER["blob"]]

    def near(side: DataFrame, kinds: list) -> DataFrame:
        other = here.filter(F.col("kind").isin(kinds)).select(
            F.col("row").alias("o_row"), F.col("scope").alias("o_scope"), F.col("start").alias("o_start"), F.col("end").alias("o_end"),
            F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda d: F.floor(F.col("start") / REACH) + d)).alias("o_bin"))
        # a side grows with the documents: no broadcast, whatever its estimate
        return side.join(other.hint("merge"), (F.col("row") == F.col("o_row")) & (F.col("scope") == F.col("o_scope")) & (F.col("bin") == F.col("o_bin"))
                         & (F.abs(F.col("start") - F.col("o_start")) <= REACH)
                         & ((F.col("end") <= F.col("o_start")) | (F.col("o_end") <= F.col("start"))), "left_semi")

    ident, blob, endpoint = (weak.filter(F.col("kind") == ORDER[k]) for k in WEAK)
    linked = near(ident, secrets).unionByName(near(blob, idents)).unionByName(near(near(endpoint, idents), secrets))
    return linked.select("row", "doc_id", "hash", "kind", "start", "end")


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, hash of its text and spans (array of start, kind
    number, end): strong parts and linked weak ones, by start and then kind."""
    parts = materialise(find_parts(docs), "secret-parts")
    strong = F.col("kind").isin([ORDER[k] for k in STRONG])
    # weak parts stay as rows without a kind, so that their document keeps its row
    rows = parts.select("row", "doc_id", "hash", *[F.when(strong, F.col(c)).alias(c) for c in ("kind", "start", "end")])
    span = F.when(F.col("kind").isNotNull(), F.struct("start", "kind", "end"))
    return rows.unionByName(link_parts(parts)).groupBy("row", "doc_id", "hash").agg(F.array_sort(F.collect_list(span)).alias("spans"))


def spans_text(spans):
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k, _, _ in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of its text replaced by MASK; same columns.
    Only texts that may hold a span move (a weak part has none without a strong
    one or an identifier); they meet their spans by doc_id and the text's hash.
    Overlapping spans are masked as one."""
    text = F.col("text")
    may = F.lit(False)
    for kind, _, test in KINDS:
        if kind in (*STRONG, "ident"):
            may = may | test(text)
    may = F.coalesce(may, F.lit(False))
    found = scan_secrets(docs).filter(F.size("spans") > 0).dropDuplicates(["doc_id", "hash"])
    found = found.select(F.col("doc_id").alias("s_doc"), F.col("hash").alias("s_hash"), _merged_spans("spans").alias("s_spans"))
    packed = docs.filter(may).select(F.struct(*docs.columns).alias("whole"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    hit = packed.join(found, F.col("doc_id").eqNullSafe(F.col("s_doc")) & (F.xxhash64("text") == F.col("s_hash")), "left")
    before = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get("s_spans", i - 1)["end"])
    pieces = F.transform("s_spans", lambda s, i: F.concat(
        F.substring(text, (before(i) + 1).cast("int"), (s["start"] - before(i)).cast("int")), F.lit(MASK)))
    tail = F.substring(text, (F.try_element_at("s_spans", F.lit(-1))["end"] + 1).cast("int"), F.length(text))
    masked = F.when(F.size("s_spans") > 0, F.concat(F.array_join(pieces, ""), tail)).otherwise(text)
    return hit.select(F.col("whole").withField("text", masked).alias("whole")).select("whole.*").unionByName(docs.filter(~may))


def _merged_spans(name: str):
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def step(out, x):
        last = F.try_element_at(out, F.lit(-1))
        one = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        new = F.struct(x["start"].alias("start"), x["end"].alias("end"))
        return F.when((F.size(out) > 0) & (x["start"] <= last["end"]),
                      F.concat(F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0))), F.array(one))).otherwise(F.concat(out, F.array(new)))

    return F.aggregate(F.col(name), empty, step)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scan_secrets(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == ORDER[k])).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(STRONG))
    return got.select("doc_id", *[count(k).alias(f"n_{k}") for k in STRONG], F.sha2(spans_text(base), 256).alias("base_sha256"),
                      spans_text(F.col("spans")).alias("spans"))
