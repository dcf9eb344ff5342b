"""Secret scans over a trigram inverted index.

Each rule's regular expression gives a Boolean trigram query (``trigrams``).  The index holds
the postings of every trigram that a query names, as lists of documents per (trigram, block
of documents); a query intersects the postings of its trigrams block by block, and only the
documents that come out are verified with the rule's expression.  A rule without mandatory
trigrams has no posting to look up and scans every text.

A document's key is the hash of its doc_id: a collision only adds a text to verify.  Blocks
come from the key, so a list holds at most about ``BLOCK_ROWS`` keys, whatever the share of
documents that a trigram occurs in.  The index is written to the shared
scratch folder.

Spans are found without Python: a text split at the matches gives the pieces between them,
and running lengths of pieces and matches are the positions, in code points.

Defined results: a null text is the empty text; a null doc_id has a key too; rows
that share a doc_id share postings, and each is verified on its own text; no span gives the
hash of the empty string; very long texts are scanned whole; spans that begin at one place stand in the rules'
order; an empty table gives an empty result; other columns are kept if asked for, whatever their names; a private key's span holds its key lines and END line, so nothing of
the key is left where spans are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fulcrum.llm.scratch import Scratch
from fulcrum.llm.trigrams import trigram_query
from fulcrum.llm.words import text_or_empty

BLOCK_ROWS = 4096


@dataclass(frozen=True)
class SecretRule:
    kind: str
    pattern: str
    least: int  # characters of ``group`` below which a match is dropped
    group: int = 0
    look: str | None = None  # a cheaper expression that every text with a kept match satisfies

    @property
    def query(self):
        return trigram_query(self.pattern)


#: Fixed base rules, in listed order.
BASE_RULES = (
    SecretRule("assign",
               r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    SecretRule("access", r"AKIA[A-Z0-9]+", 18),
    SecretRule("hex", r"[0-9a-f]+", 16, look=r"[0-9a-f]{16}"),
)
#: A private key: from its BEGIN line up to its END line if that comes before any other run of five
#: dashes, else the BEGIN line with the header fields and key lines that follow (runs of at least 16
#: characters, and after them a shorter one that is padded or ends its line).  Lines may be quoted,
#: escaped or prefixed as in source code.  Loops are possessive, so time and stack stay bounded.
_BETWEEN = r"""(?:[\s"'+,;>#*|]|\\[nrt]?)*+"""
_KEY_LINES = (
    rf"""(?:{_BETWEEN}(?:Proc-Type|DEK-Info):[^\r\n\\]*+)*+(?:(?:{_BETWEEN}[A-Za-z0-9+/]{{16,}}+)++"""
    rf"""(?:=++|{_BETWEEN}(?:[A-Za-z0-9+/]++=++|[A-Za-z0-9+/]++(?![ \t]*+[^\s"'\\])))?+)?+""")
PRIVATE_KEY = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
    rf"(?:[^-]*+(?:-{{1,4}}+[^-]++)*+-----+END [A-Z ]*PRIVATE KEY-----|{_KEY_LINES})")
#: Further kinds; each has mandatory trigrams.
MORE_RULES = (
    SecretRule("pem", PRIVATE_KEY, 0),
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    SecretRule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 30),
)
RULES = BASE_RULES + MORE_RULES


def index_vocabulary(rules: tuple[SecretRule, ...]) -> list[str]:
    return sorted({t for r in rules for conj in r.query or () for t in conj})


def trigram_index(keyed: DataFrame, vocabulary: list[str], scratch: Scratch, blocks: int) -> DataFrame:
    """Postings (trigram, block, keys) of a table (_key, _text).  The trigrams that no query
    names are never looked up, so they get no postings."""
    low = F.lower("_text")
    present = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in vocabulary]))
    return scratch.write(
        keyed.select("_key", F.explode(present).alias("trigram"))
        .groupBy("trigram", F.pmod(F.col("_key"), F.lit(blocks)).alias("block"))
        .agg(F.collect_set("_key").alias("keys")),
        "postings")


def candidates(postings: DataFrame, rules: tuple[SecretRule, ...]) -> DataFrame:
    """(_key, _rules): for each document that passes a query, the bits of those rules."""
    spark = postings.sparkSession
    terms = [(n, i, t, len(conj))
             for n, (i, conj) in enumerate((i, c) for i, r in enumerate(rules) for c in sorted(r.query or (), key=sorted))
             for t in sorted(conj)]
    queries = F.broadcast(spark.createDataFrame(  # one row per rule, conjunction and trigram
        terms, "conj int, rule int, trigram string, needed int"))
    found = (
        postings.join(queries, "trigram")
        .groupBy("conj", "rule", "needed", "block").agg(F.collect_list("keys").alias("lists"))
        .where(F.size("lists") == F.col("needed"))
        .select("rule", F.explode(F.aggregate(
            F.slice("lists", 2, F.size("lists")), F.get("lists", F.lit(0)), F.array_intersect)).alias("_key"))
    )
    bit = F.expr("shiftleft(1, rule)")
    return found.groupBy("_key").agg(F.bit_or(bit).alias("_rules"))


def _matches(rule: SecretRule, text: Column, look: Column) -> list[Column]:
    """(pieces between the matches, the matches, what must be long enough) where ``look``."""
    each = lambda group: F.when(look, F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(group)))
    return [F.when(look, F.split(text, rule.pattern, -1)), each(0), each(rule.group)]


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _chunks(items: Column) -> Column:
    """An array in consecutive parts of about the square root of its length."""
    size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(items).cast("double"))).cast("int"))
    return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(1), F.ceil(F.size(items) / size).cast("int")) - F.lit(1)),
                       lambda c: F.slice(items, c * size + F.lit(1), size))


def _folded(items: Column, start: Column, made: str, step, after) -> Column:
    """Array of what ``step(state, item)`` makes of each item (an array), where ``after(state, item)`` is the next state.

    Growing one array item by item would copy it each time; here parts of root n items are built
    on their own and joined, so n items cost about n * root n copied references."""
    empty = F.array().cast(f"array<{made}>")
    inner = lambda state, part: F.aggregate(
        part, F.struct(state.alias("at"), empty.alias("out")),
        lambda acc, x: F.struct(after(acc["at"], x).alias("at"), F.concat(acc["out"], step(acc["at"], x)).alias("out")))
    outer = F.aggregate(
        _chunks(items), F.struct(start.alias("at"), F.array().cast(f"array<array<{made}>>").alias("out")),
        lambda acc, part: _let(inner(acc["at"], part), lambda done: F.struct(
            done["at"].alias("at"), F.array_append(acc["out"], done["out"]).alias("out"))))
    return F.flatten(_let(outer, lambda done: done["out"]))


_SPAN = "struct<start:int,nr:int,end:int,kind:string>"


def _spans(rule: SecretRule, order: int, pieces: Column, found: Column, judged: Column) -> Column:
    """Array of (start, order, end, kind) of the matches that are long enough."""
    lengths = lambda texts: F.transform(texts, F.length)
    sizes = F.arrays_zip(F.slice(lengths(pieces), F.lit(1), F.size(found)).alias("gap"), lengths(found).alias("size"),
                         lengths(judged).alias("judged"))
    span = lambda at, x: F.struct(
        (at + x["gap"]).alias("start"), F.lit(order).alias("nr"), (at + x["gap"] + x["size"]).alias("end"), F.lit(rule.kind).alias("kind"))
    empty = F.array().cast(f"array<{_SPAN}>")
    return F.when(F.size(found) > 0, _let(sizes, lambda z: _folded(
        z, F.lit(0), _SPAN, lambda at, x: F.when(x["judged"] >= F.lit(rule.least), F.array(span(at, x))).otherwise(empty),
        lambda at, x: at + x["gap"] + x["size"]))).otherwise(empty)


def scan(docs: DataFrame, scratch: Scratch, keep: tuple[str, ...] = ("doc_id",),
         rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """``keep`` columns, ``text`` (never null), and ``spans``: array of (start, nr, end, kind) by
    start, then rule; ``nr`` is the rule's place in ``rules``."""
    keyed = docs.select(
        *[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)],
        F.xxhash64("doc_id").alias("_key"), text_or_empty("text").alias("_text"))
    vocabulary = index_vocabulary(rules)
    blocks = max(1, -(-docs.count() // BLOCK_ROWS))
    postings = trigram_index(keyed.select("_key", "_text"), vocabulary, scratch, blocks)
    # written first: the join that brings them to the texts is planned by their real size
    passing = scratch.write(candidates(postings, rules).withColumnRenamed("_key", "_c"), "candidates")
    joined = keyed.join(passing, F.col("_key") == F.col("_c"), "left")
    for i, rule in enumerate(rules):
        if rule.query is None:
            look = F.col("_text").rlike(rule.look or rule.pattern)
        else:
            look = F.coalesce(F.col("_rules"), F.lit(0)).bitwiseAND(F.lit(1 << i)) != F.lit(0)
        joined = joined.withColumns(dict(zip(
            (f"_p{i}", f"_m{i}", f"_j{i}"), _matches(rule, F.col("_text"), look))))
    spans = [_spans(r, i, F.col(f"_p{i}"), F.col(f"_m{i}"), F.col(f"_j{i}")) for i, r in enumerate(rules)]
    return joined.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.col("_text").alias("text"),
        F.sort_array(F.concat(*spans)).alias("spans"))


def span_string(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """``text`` with each run of overlapping spans replaced by the first one's ``[kind]``.

    The text is cut once per part of the spans and each span inside its own cut, as a look at a
    place in a text costs what stands before it."""
    kept = _folded(  # where a run begins, with the end of all spans before it
        spans, F.lit(0), "struct<before:int,start:int,kind:string>",
        lambda at, s: F.when(s["start"] >= at, F.array(F.struct(
            at.alias("before"), s["start"].alias("start"), s["kind"].alias("kind"))))
        .otherwise(F.array().cast("array<struct<before:int,start:int,kind:string>>")),
        lambda at, s: F.greatest(at, s["end"]))

    def cut(part: Column) -> Column:
        """What stands before each run of the part, and the runs' kinds."""
        begin = F.get(part, F.lit(0))["before"]
        own = F.substring(text, begin + F.lit(1), F.element_at(part, -1)["start"] - begin)
        return _let(own, lambda t: F.array_join(F.transform(part, lambda s: F.concat(
            F.substring(t, s["before"] - begin + F.lit(1), s["start"] - s["before"]), F.lit("["), s["kind"], F.lit("]"))), ""))

    end = F.array_max(F.transform(spans, lambda s: s["end"]))
    done = F.concat(F.array_join(F.transform(_let(kept, _chunks), cut), ""), F.substring(text, end + F.lit(1), F.length(text)))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def redact_documents(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` with their secrets replaced in ``text`` (and ``n_chars``, if there, brought up to
    date where the text changed); a text without secrets stays as it is, null included."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    found = scan(docs.select("doc_id", "text", row), scratch, keep=("_row",))
    hit = F.size("spans") > 0
    clean = found.withColumn("_clean", F.when(hit, redact(F.col("text"), F.col("spans"))))
    out = []
    for c in docs.columns:
        now = F.col("_row").getField(c)
        if c == "text":
            now = F.when(hit, F.col("_clean")).otherwise(now)
        elif c == "n_chars":
            now = F.when(hit, F.length("_clean")).otherwise(now).cast(docs.schema[c].dataType)
        out.append(now.alias(c))
    return clean.select(*out)
