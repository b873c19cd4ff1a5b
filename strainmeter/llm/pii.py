"""Personal data by candidate gradient boosting, in DataFrame operations only.

High-recall generators propose spans that may overlap: the four base formats
(email, ip, card, phone), written-out addresses ("name at host dot com") and
any long number. Boosted trees (MLlib) score each candidate from its format
(length, digits, separators, case, ending) and its context (words before it).

They learn without labels of the target: in all documents the base formats'
own checks (Luhn, part and digit counts) say which candidates are personal
data. A written address never is a base match, so the real
addresses, with their contexts, are rendered as people write them out ("at",
"(at)", "[at]" and dots likewise), with a few stated ones for corpora without
any; the same rendering of ordinary words of the texts gives what only looks
like an address. Per kind, the threshold is the lowest score whose precision on
the held-out half reaches ``PRECISION``. Base spans that pass their checks
always stay; the trees add others that reach the threshold and overlap no base
span.

The trees become one SQL expression, so scoring is a single narrow pass over
the texts: no shuffle, no Python, no second read.

Places: Spark gives a pattern's matches but not where they are. The pieces
between them (split by the same pattern) do: a match starts where the pieces
and matches before it end, summed in blocks of ``BLOCK`` matches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRECISION = 0.98
TREES, DEPTH = 12, 3
CONTEXT = 24
BLOCK = 64
#: Written addresses and common endings of hosts.
WRITTEN = (
    "jane.doe at example dot com", "j.smith42 at mail dot org", "info (at) company (dot) net", "support [at] service [dot] io",
    "maria_lopez at correo dot es", "hans.meier at firma dot de", "contact at site dot fr", "anna7 (at) uni (dot) edu",
    "bob at host dot co dot uk", "sales (at) shop (dot) com", "k.lee99 [at] lab [dot] org", "press at paper dot news",
)
ENDINGS = "com|org|net|edu|gov|io|co|info|biz|de|fr|es|uk|eu|it|nl|ch|at|us|ca|news|dev|app"

#: Formats of the base kinds. ``\G`` and the look-behind start a
#: match only where a run of its first class starts (or the last match ended):
#: the same matches, without trying a long run from each of its places.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators of further candidates.
LOOSE = {
    "written": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]{2,64}+(?: ?\(at\) ?| ?\[at\] ?| at )[A-Za-z0-9-]{1,63}+(?:(?: ?\(dot\) ?| ?\[dot\] ?| dot )[A-Za-z0-9-]{1,63}+)++",
    "number": r"(?<![A-Za-z0-9])[0-9][0-9().\x20/-]{5,40}[0-9](?![A-Za-z0-9])",
}
KINDS = {**BASE, **LOOSE}
#: A text without this character or pattern has no match of the kind.
_HINT = {"email": "@", "phone": "+"}
_CUES = ("mail", "phone|tel|call|fax|mobile", "card|visa|credit|payment", "ip|host|server|address", "ssn|passport|account|iban|id")
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


def _lit(pattern: str) -> Column:
    return F.lit(pattern)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def valid(kind: str, hit: Column) -> Column:
    """Whether a match of a base format passes its check."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return hit.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    n = F.length(_digits(hit))
    if kind == "card":
        return n.between(16, 19) & F.call_function("luhn_check", _digits(hit))
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(False)


def _located(kind: str, text: Column, hits: Column, gaps: Column) -> Column:
    """Array of candidates (kind, start, end, hit, before, valid)."""
    empty = F.expr("cast(array() as array<struct<kind:string,s:int,e:int,hit:string,before:string,valid:boolean>>)")

    def step(state: Column, x: Column) -> Column:
        hit = x["hit"]
        start = state["at"] + x["gap"]
        end = start + F.length(hit)
        back = F.lower(F.substring(text, F.greatest(start - CONTEXT, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT))))
        one = F.struct(F.lit(kind).alias("kind"), start.alias("s"), end.alias("e"), hit.alias("hit"), back.alias("before"), valid(kind, hit).alias("valid"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    # a block's candidates are appended one by one; the blocks' places come
    # from the sums of their lengths, so a text with many hits stays cheap
    each = F.zip_with(hits, F.slice(gaps, 1, F.size(hits)), lambda h, g: F.struct(h.alias("hit"), g.alias("gap")))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / BLOCK).cast("int")), lambda b: F.slice(each, b * BLOCK + 1, F.lit(BLOCK)))
    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda t, x: t + F.length(x["hit"]) + x["gap"]))
    ints = F.expr("cast(array() as array<int>)")
    begins = F.aggregate(sums, F.struct(F.lit(0).alias("at"), ints.alias("out")), lambda t, n: F.struct((t["at"] + n).alias("at"), F.concat(t["out"], F.array(t["at"])).alias("out")), lambda t: t["out"])
    found = F.flatten(F.zip_with(blocks, begins, lambda b, at: F.aggregate(b, F.struct(at.alias("at"), empty.alias("out")), step, lambda s: s["out"])))
    return F.when(F.size(hits) > 0, found).otherwise(empty)


def candidates(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``found``: an array of candidates for each kind of
    generator, base kinds first."""
    text = F.col("_text")
    rows = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    hits = {}
    for kind, pattern in KINDS.items():
        every = F.regexp_extract_all(text, _lit(pattern), F.lit(0))
        none = F.expr("cast(array() as array<string>)")
        hint = text.contains(_HINT[kind]) if kind in _HINT else F.lit(True)
        if kind == "written":
            hint = F.lower(text).contains("dot")
        hits[f"_h_{kind}"] = F.when(hint, every).otherwise(none)
    rows = rows.withColumns(hits)
    for kind, pattern in KINDS.items():
        # where all cards have too few digits, their places aren't needed
        least = 16 if kind == "card" else 1
        long = F.exists(f"_h_{kind}", lambda h: F.length(h) >= least)  # noqa: B023
        gaps = F.transform(F.split(text, pattern, -1), F.length)
        rows = rows.withColumn(f"_g_{kind}", F.when((F.size(f"_h_{kind}") > 0) & long, gaps))
    found = [F.when(F.col(f"_g_{k}").isNotNull(), _located(k, text, F.col(f"_h_{k}"), F.col(f"_g_{k}"))) for k in KINDS]
    return rows.select(*keep, *[f.alias(k) for f, k in zip(found, KINDS, strict=True)])


def features(c: Column) -> dict[str, Column]:
    """Numbers that describe a candidate (a struct column)."""
    hit, digits = c["hit"], _digits(c["hit"])
    count = lambda cls: (F.length(hit) - F.length(F.regexp_replace(hit, cls, ""))).cast("double")
    out = {"length": F.length(hit).cast("double"), "digits": F.length(digits).cast("double")}
    out |= {"blanks": count(" "), "dashes": count("-"), "dots": count(r"\."), "marks": count(r"[()/+]"), "letters": count("[A-Za-z]"), "ats": count("@")}
    out |= {"ending": F.lower(hit).rlike(rf"(?:dot|\(dot\)|\[dot\]) ?(?:{ENDINGS})$").cast("double"), "parts": F.size(F.split(hit, r"(?: dot | ?\(dot\) ?| ?\[dot\] ?)")).cast("double")}
    out |= {"brackets": hit.rlike(r"[\[(](?:at|dot)[\])]").cast("double"), "name": hit.rlike("^[A-Za-z0-9%+-]*[._0-9]").cast("double"), "last": F.length(F.regexp_extract(hit, "([A-Za-z0-9-]*)$", 1)).cast("double")}
    out |= {"luhn": F.call_function("luhn_check", digits).cast("double"), "zero": hit.rlike("^0").cast("double"), "plus": c["before"].rlike(r"\+[0-9 ()-]{0,4}$").cast("double")}
    for i, cue in enumerate(_CUES):
        out[f"cue{i}"] = c["before"].rlike(rf"\b(?:{cue})").cast("double")
    for kind in KINDS:
        out[f"is_{kind}"] = (c["kind"] == kind).cast("double")
    return out


@dataclass
class Model:
    """Trees as SQL over columns named by the features, and thresholds."""

    names: list[str]
    trees: list[tuple[float, object]]
    bounds: dict[str, float]

    def margin(self, numbers: dict[str, Column]) -> Column:
        def walk(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            name, at, left, right = node
            return F.when(numbers[name] <= at, walk(left)).otherwise(walk(right))

        total = F.lit(0.0)
        for weight, node in self.trees:
            total = total + F.lit(weight) * walk(node)
        return total

    def accepted(self, c: Column) -> Column:
        """Whether a candidate outside the base kinds reaches its threshold."""
        if not self.trees:
            return F.lit(False)
        score = self.margin(features(c))
        out = F.lit(False)
        for kind, bound in self.bounds.items():
            out = out | ((c["kind"] == kind) & (score >= bound))
        return out


def _node(node, names: list[str]):
    """A fitted tree's node as (feature, threshold, left, right) or a leaf."""
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return names[split.featureIndex()], float(split.threshold()), _node(node.leftChild(), names), _node(node.rightChild(), names)


def _overlaps(c: Column, others: list[Column]) -> Column:
    out = F.lit(False)
    for o in others:
        out = out | F.coalesce(F.exists(o, lambda b: b["valid"] & (b["s"] < c["e"]) & (c["s"] < b["e"])), F.lit(False))
    return out


def _rendered(address: Column, style: Column) -> Column:
    """``address`` with its marks written out in one of three styles."""
    parts = F.split(address, "@")
    out = F.lit(None).cast("string")
    for i, (at, dot) in enumerate(((" at ", " dot "), (" (at) ", " (dot) "), (" [at] ", " [dot] "))):
        out = F.when(style == i, F.concat(parts[0], F.lit(at), F.replace(parts[1], F.lit("."), F.lit(dot)))).otherwise(out)
    return out


def written_examples(found: DataFrame, some: DataFrame) -> DataFrame:
    """(_k, c: kind, hit, before, label) of written addresses to learn from:
    the real addresses and the stated ones, rendered, and ordinary
    words in the same form."""
    style = F.pmod(F.xxhash64("_k", "hit"), F.lit(3))
    real = found.select("_k", F.explode("email").alias("e")).where("e.valid").select("_k", F.col("e.hit").alias("hit"), F.col("e.before").alias("before"))
    real = real.select("_k", _rendered(F.col("hit"), style).alias("hit"), "before", F.lit(1.0).alias("label"))
    told = [F.struct(F.lit(w).alias("hit"), F.lit(before).alias("before"), F.lit(i).alias("i")) for w in WRITTEN for i, before in enumerate(("mail me: ", "please write to ", "contact ", "") * 2)]
    stated = some.sparkSession.range(1).select(F.explode(F.array(*told)).alias("e")).select(F.xxhash64("e.hit", "e.i").alias("_k"), "e.hit", "e.before", F.lit(1.0).alias("label"))
    words = some.select("_k", F.expr(r"regexp_extract_all(_t, '[A-Za-z]{2,}', 0)").alias("w")).where(F.size("w") >= 6)
    pick = lambda j: F.get("w", (F.pmod(F.xxhash64("_k", F.lit("place")), F.size("w") - 5) + j).cast("int"))
    address = F.concat(pick(2), F.lit("@"), pick(3), F.lit("."), pick(4))
    plain = words.select("_k", address.alias("a"), F.lower(F.concat_ws(" ", pick(0), pick(1), F.lit(""))).alias("before"))
    plain = plain.select("_k", _rendered(F.col("a"), F.lit(0)).alias("hit"), "before", F.lit(0.0).alias("label"))
    return real.unionByName(stated).unionByName(plain).select("_k", F.struct(F.lit("written").alias("kind"), "hit", "before", "label").alias("c"))


def examples(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Examples of all documents that have a digit, an at sign or a written one
    (the others have no candidate): half to learn from or hold out, kind,
    label, features. Those equal in all of them are one row and their count."""
    text = F.col(text_col)
    some = docs.select(text.alias("_t"), F.xxhash64(text).alias("_k")).where(text.rlike(r"[0-9@]| at |[(\[]at[)\]]"))
    found = candidates(some, "_t", ["_k"])
    base = [F.col(k) for k in BASE]
    every = F.concat(*[F.coalesce(F.col(k), F.expr("cast(array() as array<struct<kind:string,s:int,e:int,hit:string,before:string,valid:boolean>>)")) for k in KINDS])
    every = F.transform(every, lambda c: F.struct(*[c[x].alias(x) for x in ("kind", "hit", "before")], _overlaps(c, base).cast("double").alias("label")))
    # a real written candidate has no label of its own: it isn't an example
    one = found.select("_k", F.explode(F.filter(every, lambda c: c["kind"] != "written")).alias("c"))
    one = one.unionByName(written_examples(found, some))
    half = F.pmod(F.xxhash64("_k"), F.lit(2)).alias("_half")
    table = one.select(half, F.col("c.kind").alias("kind"), F.col("c.label").alias("label"), *[v.alias(k) for k, v in features(F.col("c")).items()])
    counted = table.groupBy(*table.columns).agg(F.count(F.lit(1)).cast("double").alias("n"))
    return counted.sortWithinPartitions(*table.columns)


def trained(docs: DataFrame, text_col: str = "text") -> Model:
    """Boosted trees and thresholds from the examples of all documents, each
    with its count as its weight."""
    table = examples(docs, text_col).cache()
    names = [c for c in table.columns if c not in ("_half", "kind", "label", "n")]
    try:
        learn = table.where("_half = 0")
        if learn.select("label").distinct().count() < 2:
            return Model(names, [], {})
        vector = VectorAssembler(inputCols=names, outputCol="x").transform(learn)
        fit = GBTClassifier(featuresCol="x", labelCol="label", weightCol="n", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, subsamplingRate=1.0).fit(vector)
        trees = [(float(w), _node(t._call_java("rootNode"), names)) for w, t in zip(fit.treeWeights, fit.trees, strict=True)]
        model = Model(names, trees, {})
        held = table.where("_half = 1").where(F.col("kind").isin(*LOOSE))
        scored = held.select("kind", F.round(model.margin({c: F.col(c) for c in names}), 6).alias("m"), "label", "n")
        steps = scored.groupBy("kind", "m").agg(F.sum(F.col("label") * F.col("n")).alias("hits"), F.sum("n").alias("n")).collect()
        for kind in LOOSE:
            hits = n = 0.0
            for r in sorted((r for r in steps if r["kind"] == kind), key=lambda r: -r["m"]):
                hits, n = hits + r["hits"], n + r["n"]
                if n >= 20 and hits / n >= PRECISION:
                    model.bounds[kind] = r["m"]
        return model
    finally:
        table.unpersist()


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_email, n_ip, n_card, n_phone,
    n_added, base_sha256 (of the base spans) and spans (all; kind:start:end by
    kind, then start; code points, end exclusive).

    A null text is empty. Null ids and repeated rows are rows of their own;
    other columns aren't read. Without two sorts of candidates to learn from,
    nothing is added to the base."""
    model = trained(docs, text_col)
    rows = candidates(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_body")), "_body", ["_id"])
    none = F.expr("cast(array() as array<string>)")
    show = lambda c: F.concat_ws(":", c["kind"], c["s"].cast("string"), c["e"].cast("string"))
    base = {k: F.coalesce(F.transform(F.filter(k, lambda c: c["valid"]), show), none) for k in BASE}
    more = {k: F.coalesce(F.transform(F.filter(k, lambda c: model.accepted(c) & ~_overlaps(c, [F.col(b) for b in BASE])), show), none) for k in LOOSE if k in model.bounds}
    rows = rows.select("_id", *[v.alias(f"b_{k}") for k, v in base.items()], F.concat(none, *more.values()).alias("added"))
    joined = F.concat(*[F.col(f"b_{k}") for k in BASE])
    return rows.select(
        F.col("_id").alias(id_col),
        *[F.size(f"b_{k}").cast("long").alias(f"n_{k}") for k in BASE],
        F.size("added").cast("long").alias("n_added"),
        F.sha2(F.array_join(joined, ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.concat(joined, F.col("added")), ",").alias("spans"),
    )
