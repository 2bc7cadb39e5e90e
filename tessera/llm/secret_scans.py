"""Secret scans with DataFrame functions only: three fixed patterns, and character Markov models over every long run of characters.

Two first-order character models, one of random strings and one of ordinary words and identifiers, are trained by counting
character pairs of labelled tokens: some made by rule, and those of all documents. Tokens of base spans are random; words of letters in
documents without base spans, and long runs without a digit that touch no base span, are ordinary, in capitals too. All words train, and of the other
tokens those of one half of the documents. The other half's long ordinary runs, with
identifiers made by rule that took no part in training, set a threshold for the ratio a character, which one in a thousand may exceed; it is the same
rule at every size, since the identifiers are always there. Every run of MARKOV_LEAST characters or more is judged, inside base
spans and out: it is a secret where its log-likelihood ratio is over MARKOV_OVER and, a character, over that threshold.

Null and empty texts have no spans. Repeated rows are scanned one by one. Spans are in code points, end exclusive.
Only the id and text columns are read (``redact`` passes all columns through), so extra columns can have any names.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import dropped, let, stored

# The patterns and least lengths that define the base kinds.
ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")

#: Runs that the models judge.
MARKOV_LEAST = 16
MARKOV = r"[A-Za-z0-9+/_=-]{16,}"
#: Total log-likelihood ratio (natural log) from which a run can be random, and the share of ordinary runs that may exceed the fitted one a character.
MARKOV_OVER = 6.0
FALSE_ALARMS = 0.001
#: The documents' words train as so many.
WORDS = 20_000
#: An ordinary pair of small letters counts so much in capitals.
CAPITALS = 0.1

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
K = len(ALPHABET) + 1  # 0 stands for any other character and for the start

#: Words that the generator of ordinary identifiers joins.
PLAIN = (
    "get set is has load save read write open close start stop user name file path data list item count size index key value node tree table row column "
    "page image frame point time date year month day hour event order part line text word number code error message request response client server "
    "session config option default version module function class object array string int long double float bool max min sum mean total first last next "
    "prev parent child left right top bottom width height color style type kind state status result report test build cache buffer stream thread task job"
).split()


def samples(spark: SparkSession, n: int = 4000, first: int = 0) -> DataFrame:
    """token, random, n (1): 2n labelled tokens made by rule, other ones for each `first` that is n away."""
    i = F.col("id").cast("string")
    word = lambda k: F.element_at(F.array(*map(F.lit, PLAIN)), (F.pmod(F.xxhash64(i, F.lit(k)), F.lit(len(PLAIN))) + 1).cast("int"))
    number = F.pmod(F.xxhash64(i, F.lit(9)), F.lit(100)).cast("string")
    date = F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), F.pmod(F.xxhash64(i, F.lit(8)), F.lit(11_000)).cast("int")), "yyyy-MM-dd")
    style = F.pmod(F.col("id"), F.lit(4))
    base64 = F.substring(F.base64(F.unhex(F.sha2(i, 512))), 1, 40)
    random = F.when(style == 0, base64).when(style == 1, F.substring(F.sha2(i, 256), 1, 40)).when(style == 2, F.upper(F.regexp_replace(base64, "[+/=]", "7"))).otherwise(F.regexp_replace(base64, "[+/=]", "x"))
    version = F.concat_ws("-", word(1), word(2), F.concat(F.lit("v"), number), date)
    plain = F.element_at(F.array(
        F.concat_ws("_", word(1), word(2), word(3), number), F.concat(word(1), F.initcap(word(2)), F.initcap(word(3)), number), F.upper(F.concat_ws("_", word(1), word(2), word(3), number)),
        F.concat_ws("-", word(1), word(2), number, word(3), word(4)), version, F.concat_ws("/", date, word(1), F.concat_ws("_", word(2), number)),
    ), (F.pmod(F.xxhash64(i, F.lit(7)), F.lit(6)) + 1).cast("int"))
    return spark.range(first, first + n).select(F.explode(F.array(F.struct(random.alias("token"), F.lit(True).alias("random")), F.struct(plain.alias("token"), F.lit(False).alias("random")))).alias("s")).select("s.*", F.lit(1).cast("long").alias("n"))


def _codes(token: Column) -> Column:
    """0 for the start, then each character's place in ALPHABET (0: not in it)."""
    return F.concat(F.array(F.lit(0)), F.transform(F.split(token, ""), lambda c: F.when(c == "", F.lit(0)).otherwise(F.position(c, F.lit(ALPHABET)))))


@dataclass(frozen=True)
class Model:
    """log P(b|a, random) - log P(b|a, plain) at a * K + b, and the ratio a character from which a run is random."""

    weights: tuple[float, ...]
    each: float = 0.0

    def random(self, token: Column, ratio: Column) -> Column:
        return (ratio > MARKOV_OVER) & (ratio > self.each * F.length(token))


def labelled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """token, random, held, word, n: labelled tokens of all documents and how often they occur; held are for the threshold, word says that a token is a word of prose."""
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("t"), F.pmod(F.xxhash64(id_col, F.lit(1)), F.lit(2)).alias("h"))
    token = lambda t, random, word: F.struct(t.alias("token"), F.lit(random).alias("random"), F.lit(word).alias("word"))

    def tokens(base: Column) -> Column:
        secret = F.transform(base, lambda s: token(F.when(s["kind"] == 0, F.regexp_extract(s["token"], ASSIGN, 1)).otherwise(s["token"]), True, False))
        plain = F.filter(_matches(F.col("t"), MARKOV, MARKOV, 0, MARKOV_LEAST, 3), lambda s: ~s["token"].rlike("[0-9]") & ~_touches(s, base))
        words = F.when(F.size(base) == 0, F.regexp_extract_all(F.col("t"), F.lit("[A-Za-z]{3,}"), 0)).otherwise(F.array().cast("array<string>"))
        return F.concat(secret, F.transform(plain, lambda s: token(s["token"], False, False)), F.transform(words, lambda w: token(w, False, True)))

    found = rows.select(F.explode(let(base_spans(F.col("t")), tokens)).alias("s"), "h").select("s.*", ((F.col("h") == 1) & ~F.col("s.word")).alias("held"))
    return found.groupBy("token", "random", "held", "word").agg(F.count("*").alias("n"))


def weights(rows: DataFrame, smooth: float = 0.5) -> tuple[float, ...]:
    """From (token, random, n): Model.weights. At most 2 * K * K counts leave the executors."""
    pairs = rows.where(F.length("token") > 0).select("random", "n", _codes(F.col("token")).alias("c"))
    pairs = pairs.select("random", "n", F.explode(F.transform(F.sequence(F.lit(1), F.size("c") - 1), lambda i: F.get(F.col("c"), i - 1) * K + F.get(F.col("c"), i))).alias("pair"))
    count = {(r["random"], r["pair"]): float(r["n"]) for r in pairs.groupBy("random", "pair").agg(F.sum("n").alias("n")).collect()}
    capital = lambda c: c + 26 if 1 <= c <= 26 else c
    for (random, pair), n in list(count.items()):  # ordinary words may stand in capitals
        a, b = divmod(pair, K)
        if not random and 1 <= b <= 26 and a <= 26:
            count[False, capital(a) * K + capital(b)] = count.get((False, capital(a) * K + capital(b)), 0.0) + CAPITALS * n
    out = []
    for a in range(K):
        total = {kind: sum(count.get((kind, a * K + b), 0) for b in range(K)) + smooth * K for kind in (True, False)}
        for b in range(K):
            p = {kind: (count.get((kind, a * K + b), 0) + smooth) / total[kind] for kind in (True, False)}
            out.append(round(math.log(p[True] / p[False]), 6))
    return tuple(out)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model of the tokens made by rule and of those of docs (which may have none)."""
    made = 4000
    tokens = stored(labelled(docs, id_col, text_col), "labelled-tokens")
    # prose counts for as many words at every size, or identifiers would become ever stranger
    total = tokens.where("not held and word").agg(F.sum("n")).first()[0] or 1
    trained = tokens.where("not held").select("token", "random", F.when(F.col("word"), F.col("n") * (WORDS / total)).otherwise(F.col("n").cast("double")).alias("n"))
    table = weights(samples(docs.sparkSession, made).unionByName(trained))
    ordinary = tokens.where("held and not random and not word").select("token").unionAll(samples(docs.sparkSession, made, made).where(~F.col("random") & (F.length("token") >= MARKOV_LEAST)).select("token"))
    highest = ordinary.agg(F.percentile_approx(llr(F.col("token"), table) / F.length("token"), 1 - FALSE_ALARMS, 10_000)).first()[0]
    dropped(tokens)
    return Model(table, max(0.0, highest))


def llr(token: Column, table: tuple[float, ...]) -> Column:
    w = F.from_json(F.lit(json.dumps(table)), "array<double>")
    return let(_codes(token), lambda c: F.aggregate(F.sequence(F.lit(1), F.size(c) - 1), F.lit(0.0), lambda acc, i: acc + F.get(w, F.get(c, i - 1) * K + F.get(c, i))))


def _running(lengths: Column, block: int = 256) -> Column:
    """Running sums of an array of ints. Sums are gathered in blocks, so that appending stays cheap in texts with very many matches."""
    one = lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"] + x)).alias("out"))

    def blocks(acc: Column, k: Column) -> Column:
        part = F.aggregate(F.slice(lengths, k * block + 1, block), F.struct(acc["at"].alias("at"), F.array().cast("array<int>").alias("out")), one)
        return let(part, lambda p: F.struct(p["at"].alias("at"), F.concat(acc["out"], F.array(p["out"])).alias("out")))

    ks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / block).cast("int"))
    return F.aggregate(ks, F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("out")), blocks, lambda acc: F.flatten(acc["out"]))


def _matches(text: Column, pattern: str, test: str, group: int, least: int, kind: int) -> Column:
    """array<struct<start, kind, end, token>> of the leftmost non-overlapping matches whose group has at least `least` characters."""

    def build(found: Column) -> Column:
        def placed(gap: Column) -> Column:
            ends = F.zip_with(F.slice(gap, 1, F.size(found)), found, lambda g, m: F.length(g) + F.length(m))
            return let(_running(ends), lambda e: F.zip_with(e, found, lambda end, m: F.struct((end - F.length(m)).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), m.alias("token"))))

        return let(F.split(text, pattern, -1), placed)

    all_ = let(F.regexp_extract_all(text, F.lit(pattern), 0), build)
    kept = F.filter(all_, lambda s: F.length(F.regexp_extract(s["token"], pattern, group)) >= least)
    return F.when(text.rlike(test), kept).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int,token:string>>"))


def base_spans(text: Column) -> Column:
    """Spans of the three base kinds by start, then kind. Runs of one character class match whole, so a least length can be part of their pattern."""
    parts = [_matches(text, ASSIGN, ASSIGN, 1, 12, 0), _matches(text, r"AKIA[A-Z0-9]{14,}", r"AKIA[A-Z0-9]{14}", 0, 18, 1), _matches(text, r"[0-9a-f]{16,}", r"[0-9a-f]{16}", 0, 16, 2)]
    return F.sort_array(F.concat(*parts))


def _touches(s: Column, base: Column) -> Column:
    return F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))


def judged(text: Column, model: Model) -> Column:
    """Every run of MARKOV_LEAST characters or more with its ratio: array<struct<start, kind, end, token, ratio>>."""
    runs = _matches(text, MARKOV, MARKOV, 0, MARKOV_LEAST, 3)
    return F.transform(runs, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["token"].alias("token"), llr(s["token"], model.weights).alias("ratio")))


def markov_spans(runs: Column, model: Model) -> Column:
    """The judged runs that the models call random, as spans."""
    return F.transform(F.filter(runs, lambda s: model.random(s["token"], s["ratio"])), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["token"].alias("token")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """id_col, base, spans: array<struct<start, kind, end, token>>, and runs (all judged runs, with ratio).

    base has the three base kinds, spans all kinds (a run and a base span may overlap), both by start, then kind.
    """
    model = model or train(docs, id_col, text_col)
    t = F.coalesce(F.col(text_col), F.lit(""))
    spans = lambda b, r: F.struct(b.alias("base"), F.sort_array(F.concat(b, markov_spans(r, model))).alias("spans"), r.alias("runs"))
    found = let(base_spans(t), lambda b: let(judged(t, model), lambda r: spans(b, r)))
    return docs.select(F.col(id_col), found.alias("__s")).select(id_col, "__s.base", "__s.spans", "__s.runs")


def digest(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]", model: Model | None = None) -> DataFrame:
    """docs with every span of text_col replaced by mark, overlapping spans by one mark. Other columns stay; null texts stay null."""
    model = model or train(docs, id_col, text_col)
    t = F.coalesce(F.col(text_col), F.lit(""))

    def cut(spans: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

        def step(acc: Column, s: Column) -> Column:
            gap = F.concat(acc["out"], F.array(F.substring(t, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))
            return F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))).otherwise(F.struct(s["end"].alias("at"), gap.alias("out")))

        return F.aggregate(spans, start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(t, acc["at"] + 1, F.length(t))))

    def whole(base: Column) -> Column:
        return let(F.sort_array(F.concat(base, markov_spans(judged(t, model), model))), lambda s: F.when(F.size(s) > 0, cut(s)).otherwise(F.col(text_col)))

    return docs.withColumn(text_col, let(base_spans(t), whole))
