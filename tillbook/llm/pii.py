"""Personal data: base patterns, then contextual bootstrapping, with DataFrame functions only.

Base spans of four kinds come from patterns and checks. They are the seeds: the two words left of a seed are a
lexical pattern. Candidates are tokens that look like identifiers, hold no base span and have such a left
context too. Patterns and instances (seeds and candidates) form a bipartite graph with one edge per distinct
pair. Each round scores a pattern by the mean confidence of its instances (with one doubtful instance added)
and an instance by the chance that not all its patterns are wrong. An instance of at least `least_score` is believed and
counts as a seed in the next round, so a pattern that only found identifiers speak for finds further ones. Candidates right
of a pattern with at least `least_score` and `least_seeds` distinct believed instances become spans of the kind `id`.

Positions are code points. The patterns are written with possessive quantifiers and a look-behind so that each
text is read in time linear in its length; what they match is what the plain patterns match.

Defined cases: a null text is empty; empty texts have no span; repeated rows (one id and text) each give a row
and count once in the graph; rows of one id with different texts are separate; a null id is a value like others.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.session import pin

# Kinds in the order of the result and their patterns.
# email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
# ip    [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
# card  [0-9]([\x20-]?[0-9])+
# phone \+[0-9][\x20().0-9-]+[0-9]
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a pattern to be tried.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
EDGE = r"""["'(),.;:!?<>\[\]{}#*$%&|=/\\-]*"""
CONTEXT_CHARS, CONTEXT_WORDS = 64, 2
CHUNK = 256

SPAN = "array<struct<start:bigint,end:bigint,text:string,left:string>>"


def _valid(kind: str, text: Column) -> Column:
    digits = F.regexp_replace(text, "[^0-9]", "")
    if kind == "ip":
        return text.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), F.call_function("luhn_check", digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _check(kind: str) -> Callable[[Column], Column]:
    return lambda span: _valid(kind, span["text"])


def _mark(kind: str) -> Callable[[Column], Column]:
    return lambda span: F.struct(span["start"].alias("start"), span["end"].alias("end"), F.lit(kind.upper()).alias("kind"))


def before(lengths: Column) -> Column:
    """Sum of all earlier entries, for each entry of an array; linear but for chunks of CHUNK entries."""
    start = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("sum"))

    def step(a: Column, x: Column) -> Column:
        return F.struct(F.concat(a["out"], F.array(a["sum"])).alias("out"), (a["sum"] + x).alias("sum"))

    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / CHUNK).cast("int")), lambda c: F.slice(lengths, c * CHUNK + 1, F.lit(CHUNK))
    )
    inner = F.transform(chunks, lambda chunk: F.aggregate(chunk, start, step))
    offsets = F.aggregate(F.transform(inner, lambda i: i["sum"]), start, step, lambda a: a["out"])
    return F.flatten(F.zip_with(inner, offsets, lambda i, o: F.transform(i["out"], lambda v: v + o)))


def left_words(piece: Column) -> Column:
    """The last two words of what stands left of a span, in lower case."""
    tail = F.lower(F.right(piece, F.lit(CONTEXT_CHARS)))
    found = F.filter(F.split(tail, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.array_join(F.slice(found, F.greatest(F.size(found) - (CONTEXT_WORDS - 1), F.lit(1)), CONTEXT_WORDS), " ")


def with_matches(rows: DataFrame, text: str, name: str, pattern: str, need: str | None = None) -> DataFrame:
    """Adds column `name`: start, end, text and left context of all matches, leftmost first.

    Matches and the pieces between them are two scans; the second only where the first found something.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<string>")
    rows = rows.withColumn(f"_m_{name}", F.when(F.col(text).contains(need), found).otherwise(none) if need else found)
    m = F.col(f"_m_{name}")
    rows = rows.withColumn(f"_p_{name}", F.when(F.size(m) > 0, F.slice(F.split(text, pattern, -1), 1, F.size(m))))
    p = F.col(f"_p_{name}")
    both = F.zip_with(p, m, lambda a, b: (F.length(a) + F.length(b)).cast("bigint"))
    rows = rows.withColumn(f"_s_{name}", F.when(F.size(m) > 0, F.zip_with(before(both), p, lambda s, a: s + F.length(a))))
    s = F.col(f"_s_{name}")
    spans = F.zip_with(
        F.zip_with(s, m, lambda at, x: F.struct(at.alias("start"), (at + F.length(x)).alias("end"), x.alias("text"))),
        p,
        lambda span, piece: F.struct(span["start"].alias("start"), span["end"].alias("end"), span["text"].alias("text"), left_words(piece).alias("left")),
    )
    return rows.withColumn(name, F.when(F.size(m) > 0, spans).otherwise(F.array()).cast(SPAN)).drop(f"_m_{name}", f"_p_{name}", f"_s_{name}")


def with_base_spans(rows: DataFrame, text: str) -> DataFrame:
    """Adds an array column per kind with the spans that pass their check."""
    for kind, pattern in PATTERNS.items():
        rows = with_matches(rows, text, kind, pattern, NEEDS.get(kind))
        if kind != "email":
            rows = rows.withColumn(kind, F.filter(kind, _check(kind)))
    return rows


def _named(kind: str) -> Column:
    return F.transform(kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def findings(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, hash of the text, counts, the base spans as text, seeds and candidates."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_base_spans(rows, "text")
    rows = with_matches(rows, "text", "token", TOKEN)
    # a token without its edges; an identifier has 4 digits or an @, and 5 to 64 characters
    core = F.transform(
        "token",
        lambda s: F.struct(
            (s["start"] + F.length(F.regexp_extract(s["text"], f"^({EDGE})", 1))).alias("start"),
            F.regexp_replace(s["text"], f"^{EDGE}|{EDGE}$", "").alias("text"),
            s["left"].alias("left"),
        ),
    )
    rows = rows.withColumn("token", core)
    shaped = F.filter(
        "token", lambda s: F.length(s["text"]).between(5, 64) & (s["left"] != "") & (s["text"].rlike("(?:[0-9][^0-9]*+){4}") | s["text"].contains("@"))
    )
    rows = rows.withColumn("token", shaped)
    all_spans = F.concat(*PATTERNS)
    rows = rows.withColumn("seed", F.filter(all_spans, lambda s: s["left"] != ""))
    free = F.filter(
        "token",
        lambda c: ~F.exists(F.concat(*PATTERNS), lambda s: (s["start"] < c["start"] + F.length(c["text"])) & (c["start"] < s["end"])),
    )
    return rows.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in PATTERNS],
        F.array_join(F.concat(*map(_named, PATTERNS)), ",").alias("base"),
        F.transform("seed", lambda s: F.struct(s["left"].alias("pattern"), F.lower(s["text"]).alias("instance"))).alias("seeds"),
        F.transform(
            free,
            lambda c: F.struct(
                c["left"].alias("pattern"),
                F.lower(c["text"]).alias("instance"),
                c["start"].alias("start"),
                (c["start"] + F.length(c["text"])).alias("end"),
            ),
        ).alias("candidates"),
    )


def pattern_scores(edges: DataFrame, rounds: int, least_score: float) -> DataFrame:
    """pattern, score and number of distinct believed instances, from edges(pattern, instance, seed)."""
    belief = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("belief"))
    for i in range(rounds):
        scores = pin(
            edges.join(belief, "instance")
            .groupBy("pattern")
            .agg((F.sum("belief") / (F.count(F.lit(1)) + 1)).alias("score"), F.count_if(F.col("belief") >= least_score).alias("seeds")),
            "pattern-scores",
        )
        if i + 1 < rounds:
            doubt = F.sum(F.log1p(-F.least("score", F.lit(0.999999))))
            believed = edges.join(scores, "pattern").groupBy("instance").agg(F.max("seed").alias("seed"), (1 - F.exp(doubt)).alias("guess"))
            belief = pin(believed.select("instance", F.when(F.col("seed"), 1.0).otherwise(F.col("guess")).alias("belief")), "beliefs")
    return scores


def discovered(found: DataFrame, rounds: int, least_score: float, least_seeds: int) -> DataFrame:
    """doc_id, text_hash and the sorted discovered spans, for the rows that have any."""
    seeds = found.select(F.explode("seeds").alias("e")).select("e.pattern", "e.instance", F.lit(True).alias("seed"))
    open_ = found.select(F.explode("candidates").alias("e")).select("e.pattern", "e.instance", F.lit(False).alias("seed"))
    edges = pin(seeds.unionAll(open_).groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "pattern-instances")
    good = pattern_scores(edges, rounds, least_score).filter((F.col("score") >= least_score) & (F.col("seeds") >= least_seeds)).select("pattern")
    hits = found.select("doc_id", "text_hash", F.explode("candidates").alias("c")).select("doc_id", "text_hash", "c.pattern", "c.start", "c.end")
    spans = F.sort_array(F.collect_set(F.struct("start", "end"))).alias("id")  # bounded by one document
    return hits.join(good, "pattern", "left_semi").groupBy("doc_id", "text_hash").agg(spans)


def personal_data(docs: DataFrame, rounds: int = 4, least_score: float = 0.8, least_seeds: int = 5) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_id for every row of docs(doc_id, text)."""
    found = pin(findings(docs), "findings")
    more = discovered(found, rounds, least_score, least_seeds).select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "id")
    joined = found.join(more, found["doc_id"].eqNullSafe(more["_doc"]) & (found["text_hash"] == more["_hash"]), "left")
    extra = F.array_join(F.transform("id", lambda s: F.concat_ws(":", F.lit("id"), s["start"].cast("string"), s["end"].cast("string"))), ",")
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), extra)
    return joined.select(
        "doc_id",
        *[f"n_{k}" for k in PATTERNS],
        F.sha2("base", 256).alias("base_sha256"),
        spans.alias("spans"),
        F.coalesce(F.size("id"), F.lit(0)).cast("long").alias("n_id"),
    )


def redact(docs: DataFrame, rounds: int = 4, least_score: float = 0.8, least_seeds: int = 5) -> DataFrame:
    """docs with every span of the text replaced by its kind in angle brackets; other columns as they were.

    Overlapping spans become one place with the kind of the first. A null text stays null.
    """
    more = discovered(pin(findings(docs), "findings"), rounds, least_score, least_seeds)
    more = pin(more, "discovered").select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), F.col("id").alias("__id"))
    columns = docs.columns
    rows = docs.select(F.struct("*").alias("__row"), F.coalesce("text", F.lit("")).alias("__text"))
    same = F.col("__row.doc_id").cast("long").eqNullSafe(F.col("__doc")) & (F.xxhash64("__text") == F.col("__hash"))
    rows = with_base_spans(rows.join(more, same, "left").drop("__doc", "__hash"), "__text")
    marks = [F.transform(k, _mark(k)) for k in PATTERNS]
    found = F.transform(F.coalesce("__id", F.array().cast("array<struct<start:bigint,end:bigint>>")), _mark("id"))
    rows = rows.withColumn("__spans", F.array_sort(F.concat(*marks, found)))
    kept = F.struct(
        F.lit(0).cast("bigint").alias("at"),
        F.array().cast("array<string>").alias("out"),
    )

    def step(a: Column, s: Column) -> Column:
        between = F.substring(F.col("__text"), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        fresh = s["start"] >= a["at"]
        return F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(a["out"], F.array(between, F.concat(F.lit("<"), s["kind"], F.lit(">"))))).otherwise(a["out"]).alias("out"),
        )

    rest = F.aggregate(
        "__spans",
        kept,
        step,
        lambda a: F.concat(F.array_join(a["out"], ""), F.substring(F.col("__text"), (a["at"] + 1).cast("int"), F.length("__text"))),
    )
    text = F.when(F.col("__row.text").isNull(), F.lit(None)).when(F.size("__spans") == 0, F.col("__text")).otherwise(rest)
    return rows.select([text.alias("text") if c == "text" else F.col(f"__row.`{c}`").alias(c) for c in columns])
