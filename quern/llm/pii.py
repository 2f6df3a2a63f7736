"""Personal data: fixed forms, and identifiers that their contexts betray.

The fixed forms are found by expression.  They seed a bootstrapped extraction: words with
digits or an at sign are instances; the word before or after one, with the instance's coarse shape (each run of
letters or digits as one sign), is a lexical pattern.  Patterns and instances form a graph.  In each round a pattern is
scored by the share of its instances that are known, and an unknown instance by the
patterns it stands in; instances scored high enough are known in the next round.  In the
end the known instances that no fixed form covers are reported as well.

Everything here is DataFrame functions; no Python sees a row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, let, matches, materialise

KINDS = ("email", "ip", "card", "phone")

# The fixed forms, written so that no text makes them slow: a match begins where a run of its
# first class does (or where the last match ended), and nothing is given back.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[ -]?+[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"

#: A word with a digit or an at sign.
INSTANCE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"

#: In a copy of the text this stands before every word of a fixed form; what the text has of it is another sign there.
MARK, _ELSE = "\ue000", "\ue001"


@dataclass(frozen=True)
class Settings:
    """rounds of the bootstrapping; a pattern needs least_support known instances and a
    share of least_confidence; an unknown instance needs a score of least_score; instances
    have least_digits digits, or an at sign.
    """

    rounds: int = 3
    least_support: float = 3.0
    least_confidence: float = 0.7
    least_score: float = 0.7
    least_digits: int = 4


def _spans(text: Column, kind: str, pattern: str, may: Column, holds) -> Column:
    number = F.lit(KINDS.index(kind))
    found = F.transform(F.filter(matches(text, pattern), lambda m: holds(m["v"])), lambda m: F.struct(number.alias("k"), m["s"].alias("s"), m["e"].alias("e")))
    return F.when(may, found).otherwise(F.array().cast("array<struct<k:int,s:bigint,e:bigint>>"))


def _octets(v: Column) -> Column:
    return F.forall(F.split(v, r"\."), lambda p: F.coalesce(F.concat(F.lit("0"), F.ltrim(p, F.lit("0"))).try_cast("int") <= 255, F.lit(False)))


def _card(v: Column) -> Column:
    digits = F.regexp_replace(v, "[ -]", "")
    return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)


def _phone(v: Column) -> Column:
    return F.length(F.regexp_replace(v, "[^0-9]", "")).between(8, 15)


#: Of each kind: the form, a cheap test of the text, and what a match must hold.
FORMS = {
    "email": (EMAIL, lambda t: t.contains("@"), lambda v: F.lit(True)),
    "ip": (IP, lambda t: t.rlike(r"[0-9]\.[0-9]"), _octets),
    "card": (CARD, lambda t: t.rlike(r"[0-9][ -]?[0-9]"), _card),
    "phone": (PHONE, lambda t: t.contains("+"), _phone),
}


def base_spans(text: Column) -> Column:
    """array<struct<k,s,e>>: the fixed forms of text, by kind as listed, then start; k is the kind's number."""
    return F.concat(*(_spans(text, kind, pattern, may(text), holds) for kind, (pattern, may, holds) in FORMS.items()))


def _marked(text: Column, kind: str) -> Column:
    """text with ``MARK`` before every word, or part of one, that a fixed form of the kind covers."""
    pattern, _, holds = FORMS[kind]
    copy = F.translate(text, MARK, _ELSE)
    parts = F.struct(F.split(copy, pattern, -1).alias("gaps"), F.regexp_extract_all(copy, F.lit(pattern), F.lit(0)).alias("found"))
    word = lambda m: F.when(holds(m), F.regexp_replace(m, r"(\S++)", MARK + "$1")).otherwise(m)
    return let(parts, lambda x: F.array_join(F.transform(x["gaps"], lambda g, i: F.concat(g, F.coalesce(word(F.get(x["found"], i)), F.lit("")))), ""))


def _edge_word(gap: Column, last: bool) -> Column:
    """The last or first word of a gap, without signs at its ends, digits as 9; of a gap without words, its signs or nothing."""
    words = F.filter(F.split(gap, r"\s+"), lambda w: w != "")
    return let(
        F.coalesce(F.try_element_at(words, F.lit(-1 if last else 1)), F.lit("")),
        lambda w: F.lower(F.regexp_replace(F.when(w.rlike(r"[\p{L}0-9]"), F.regexp_replace(w, r"^[^\p{L}0-9]++|(?<![^\p{L}0-9])[^\p{L}0-9]++$", "")).otherwise(w), "[0-9]", "9")),
    )


def _key(*parts: Column) -> Column:
    """128 bits that stand for a string of any length in the graph."""
    return F.unhex(F.md5(F.concat(*parts)))


def _instances(text: Column, base: Column, settings: Settings) -> Column:
    """array<struct<s,e,v,patterns,k>>: instances with the keys of their string and patterns; k is the kind if a fixed form covers part of the word.

    The words of a copy marked for a kind lie in the order of the text's own, so which of
    them a fixed form covers is read off place by place.
    """
    kind = "array<struct<s:bigint,e:bigint,v:binary,patterns:array<binary>,k:int>>"

    def covered(number: int) -> Column:
        words = F.regexp_extract_all(_marked(text, KINDS[number]), F.lit(INSTANCE), F.lit(0))
        return F.when(F.exists(base, lambda b: b["k"] == number), F.transform(words, lambda w: w.contains(MARK)))

    def described(x: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            lead = F.length(F.regexp_extract(m["v"], "^[^A-Za-z0-9+]*+", 0))
            core = F.regexp_replace(m["v"], "^[^A-Za-z0-9+]++|(?<![^A-Za-z0-9])[^A-Za-z0-9]++$", "")
            first = [F.when(F.coalesce(F.get(x[f"c{k}"], i), F.lit(False)), k) for k in range(len(KINDS))]
            return F.struct((m["s"] + lead).alias("s"), core.alias("v"), _edge_word(F.get(x["gaps"], i), True).alias("l"), _edge_word(F.get(x["gaps"], i + 1), False).alias("r"), F.coalesce(*first).alias("k"))

        held = F.filter(F.transform(x["found"], one), lambda y: (F.length(y["v"]) >= 2) & (y["v"].contains("@") | (F.length(F.regexp_replace(y["v"], "[^0-9]", "")) >= settings.least_digits)))

        def keyed(y: Column) -> Column:
            sort = F.when(y["v"].contains("@"), "|@").when(y["v"].rlike("[A-Za-z]"), "|a9").otherwise("|9")
            left, right = F.when(y["l"] != "", _key(F.lit("L|"), y["l"], sort)), F.when(y["r"] != "", _key(F.lit("R|"), y["r"], sort))
            both = F.when((y["l"] != "") & (y["r"] != ""), _key(F.lit("B|"), y["l"], F.lit("|"), y["r"], sort))
            return F.struct(y["s"].alias("s"), (y["s"] + F.length(y["v"])).alias("e"), _key(y["v"]).alias("v"), F.array_compact(F.array(left, right, both)).alias("patterns"), y["k"].alias("k"))

        return F.transform(held, keyed)

    read = F.struct(matches(text, INSTANCE).alias("found"), F.split(text, INSTANCE, -1).alias("gaps"), *(covered(k).alias(f"c{k}") for k in range(len(KINDS))))
    return F.when(text.rlike("[0-9@]"), let(read, described)).otherwise(F.array().cast(kind))


def _graph(read: DataFrame) -> DataFrame:
    """Edges (pattern, v, k): k is the kind if v is known by a fixed form, else null."""
    seen = read.select(F.explode("instances").alias("i")).select("i.v", "i.patterns", "i.k")
    return seen.select("v", "k", F.explode("patterns").alias("pattern")).groupBy("pattern", "v").agg(F.min("k").alias("k"))


def _bootstrap(edges: DataFrame, settings: Settings) -> tuple[DataFrame, list[str]]:
    """Unknown instances (v, k, score) that the last round accepts, and the tables written."""
    known, path = materialise(edges.where("k is not null").groupBy("v").agg(F.min("k").alias("k")).withColumn("score", F.lit(1.0)), "known")
    paths = [path]
    sizes, path = materialise(edges.groupBy("pattern").agg(F.count("*").alias("size")), "sizes")
    paths.append(path)
    accepted = known.where("false")
    for _ in range(settings.rounds):
        support = edges.select("pattern", "v").join(known.unionByName(accepted), "v").groupBy("pattern", "k").agg(F.sum("score").alias("support"))
        scored = support.where(F.col("support") >= settings.least_support).join(sizes, "pattern").select("pattern", F.col("k").alias("kind"), (F.col("support") / (F.col("size") + 1)).alias("confidence"))
        patterns, path = materialise(scored.where(F.col("confidence") >= settings.least_confidence), "patterns")
        paths.append(path)
        doubt = F.sum(F.log1p(-F.col("confidence")))
        reached = edges.where("k is null").join(patterns, "pattern").groupBy("v", "kind").agg((1 - F.exp(doubt)).alias("score")).where(F.col("score") >= settings.least_score)
        best = reached.groupBy("v").agg(F.max(F.struct("score", (-F.col("kind")).alias("kind"))).alias("b")).select("v", (-F.col("b.kind")).alias("k"), F.col("b.score").alias("score"))
        accepted, path = materialise(best.join(known.select("v"), "v", "left_anti"), "accepted")
        paths.append(path)
    return accepted, paths


def find(docs: DataFrame, text: str = "text", id_column: str = "doc_id", settings: Settings = Settings()) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every whole text; null is empty.

    The counts and base_sha256 tell the fixed forms.  spans has those and what the
    bootstrapping adds, as kind:start:end by kind, then start; code points.  Added spans
    overlap no fixed form; of kinds with equal scores the first listed is taken.  Repeated
    rows stay, also under one id with different texts; other columns are left out; no
    documents, no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    based = rows.select("id", F.xxhash64("text").alias("h"), "text", base_spans(F.col("text")).alias("base"))
    read, _ = materialise(based.select("id", "h", "base", _instances(F.col("text"), F.col("base"), settings).alias("instances")), "read")
    edges, edges_path = materialise(_graph(read), "edges")
    accepted, paths = _bootstrap(edges, settings)
    places = read.where("size(instances) > 0").select("id", "h", F.explode("instances").alias("i")).where("i.k is null").select("id", "h", "i.v", "i.s", "i.e")
    more = places.join(accepted.select("v", "k"), "v").groupBy("id", "h").agg(F.collect_set(F.struct("k", "s", "e")).alias("more"))
    more, _ = materialise(more.withColumnsRenamed({"id": "other", "h": "other_h"}), "more")
    discard(spark, edges_path, *paths)

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat(F.element_at(F.array(*map(F.lit, KINDS)), x["k"] + 1), F.lit(":"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string"))), ",")

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda x: x["k"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    joined = read.select("id", "h", "base").join(more, F.col("id").eqNullSafe(F.col("other")) & (F.col("h") == F.col("other_h")), "left")
    everything = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))
    return joined.select(F.col("id").alias(id_column), *map(count, range(len(KINDS))), F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(everything).alias("spans"))
