"""Secret scans: known forms by pattern, and a battery of randomness tests with false-discovery control. Native expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.llm.common import cut, let

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]{14,})"
HEX = r"([0-9a-f]{16,})"
TOKEN = r"([A-Za-z0-9+/_-]{20,})"
_SPAN = "array<struct<start:int,end:int,text:string>>"
#: Encodings in the order of inference: (name, pattern of the whole token, alphabet).
_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = (
    ("hex", "^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("HEX", "^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]+$", _UPPER + "234567"),
    ("base36", "^[0-9a-z]+$", _DIGITS + _LOWER),
    ("base62", "^[0-9A-Za-z]+$", _DIGITS + _UPPER + _LOWER),
    ("base64", "^[0-9A-Za-z+/]+$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", "^[0-9A-Za-z_-]+$", _UPPER + _LOWER + _DIGITS + "_-"),
)
#: Excess of a text-like token's chi-squared statistic over a random one's, per character, in an alphabet of 64.
TEXT_EXCESS = 2.2
#: Changes between words (small letters, with one capital before them), capitals and digits, marks left out, for each character of a text-like token.
TEXT_CHANGES = 0.25
#: Shortest lengths of the classes within which false discoveries are held down: a short token has less to show for itself.
LENGTHS = (20, 24, 32, 48)
BINS, PIECE = 400, 128


def matches(text, pattern: str):
    """Column: the leftmost non-overlapping matches of ``pattern`` as (start, end, text), in code points.

    The text is split at the matches, and the lengths of parts and matches add up to the places: first within pieces of PIECE
    matches, then over the pieces, so that the time stays near the number of matches.
    """
    empty = F.array().cast(_SPAN)

    def step(a, x):
        first = a["at"] + F.length(x["g"])
        last = first + F.length(x["m"])
        return F.struct(last.alias("at"), F.concat(a["out"], F.array(F.struct(first.alias("start"), last.alias("end"), x["m"].alias("text")))).alias("out"))

    def piece(pairs):
        return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("out")), step)

    def shifted(done):
        bases = F.aggregate(done, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x["at"])))
        move = lambda base: lambda x: F.struct((x["start"] + base).alias("start"), (x["end"] + base).alias("end"), x["text"].alias("text"))
        return let(bases, lambda b: F.flatten(F.transform(done, lambda x, i: F.transform(x["out"], move(F.get(b, i))))))

    def spans(pairs):
        starts = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / PIECE).cast("int"))
        return F.when(F.size(pairs) == 0, empty).otherwise(let(F.transform(starts, lambda k: piece(F.slice(pairs, k * PIECE + 1, F.lit(PIECE)))), shifted))

    found, parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    return let(found, lambda m: let(F.arrays_zip(m.alias("m"), F.slice(parts, 1, F.size(m)).alias("g")), spans))


def blanked(text, pattern: str, taken=None):
    """Column: ``text`` with blanks in place of the matches of ``pattern`` (of those for which ``taken`` holds), so that all places stay."""
    mask = lambda x: F.repeat(F.lit(" "), F.length(x))
    filled = lambda x: mask(x) if taken is None else F.when(taken(x), mask(x)).otherwise(x)
    pairs = lambda m: F.zip_with(F.split(text, pattern, -1), m, lambda g, x: F.concat(g, F.coalesce(filled(x), F.lit(""))))
    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.array_join(pairs(m), ""))).otherwise(text)


def _where(condition, value, kind: str):
    return F.when(condition, value).otherwise(F.array().cast(kind))


def _below(z):
    """Standard normal distribution function, by its logistic approximation."""
    return 1 / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), 1.5976 * z + 0.07056 * z * z * z))))


def _measured(token):
    """Column: (kind of encoding, p value against text-like tokens, p value against random ones) of a token struct, null where no encoding fits."""
    t = token["text"]
    alphabet = F.coalesce(*[F.when(t.rlike(pattern), F.lit(letters)) for _, pattern, letters in ENCODINGS])

    def measured(alphabet):
        k, n = F.length(alphabet).cast("double"), F.length(t).cast("double")
        codes = F.transform(F.split(t, ""), lambda c: (F.instr(alphabet, c) - 1).cast("double"))
        times = lambda c: (F.length(t) - F.length(F.replace(t, c, F.lit("")))).cast("double")
        squares = F.aggregate(F.transform(F.split(alphabet, ""), times), F.lit(0.0), lambda a, x: a + x * x)
        kinds = F.translate(t, _LOWER + _UPPER + _DIGITS + "+/_-", "a" * 26 + "A" * 26 + "0" * 10)
        changes = F.length(F.regexp_replace(kinds, "A?a+|A+|0+", "x")) - 1
        fields = {"start": token["start"], "end": token["end"], "k": k, "n": n, "codes": codes, "chi2": squares * k / n - n, "changes": changes.cast("double"), "mean": F.aggregate(codes, F.lit(0.0), lambda a, x: a + x) / n}
        return F.struct(*[x.alias(c) for c, x in fields.items()])

    return let(alphabet, measured)  # found once, not for each character


def _tested(m):
    """Column: (start, end, text-like p, random p) from a measured token.

    chi-squared: uniformity over the alphabet, one-sided. Runs: changes between the lower and the upper half of the alphabet.
    Serial correlation at lag one. The random p is the least of the three times three. The text-like p asks how often ordinary
    text of that length would look so even, where its chi-squared statistic is non-central in proportion to the length, and
    change so often between kinds of characters; both normal deviates count alike.
    """
    k, n, codes, chi2 = m["k"], m["n"], m["codes"], m["chi2"]
    excess = n * (TEXT_EXCESS * k / 64)
    even = (chi2 - (k - 1) - excess) / F.sqrt(2 * (k - 1) + 4 * excess)
    lively = (m["changes"] - TEXT_CHANGES * (n - 1)) / F.sqrt(TEXT_CHANGES * (1 - TEXT_CHANGES) * (n - 1))
    text_like = _below((even - lively) / 2**0.5)
    z1 = (chi2 - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    high = F.transform(codes, lambda x: (x >= k / 2).cast("double"))
    n1 = F.aggregate(high, F.lit(0.0), lambda a, x: a + x)
    both = 2 * n1 * (n - n1)
    runs = F.aggregate(F.transform(codes, lambda x, i: (F.coalesce((F.get(codes, i - 1) >= k / 2) != (x >= k / 2), F.lit(True))).cast("double")), F.lit(0.0), lambda a, x: a + x)
    spread = both * (both - n) / (n * n * (n - 1))
    z2 = F.when(spread > 0, F.abs(runs - 1 - both / n) / F.sqrt(F.greatest(spread, F.lit(1e-9)))).otherwise(F.lit(9.0))
    squares = F.aggregate(codes, F.lit(0.0), lambda a, x: a + (x - m["mean"]) * (x - m["mean"]))
    products = F.aggregate(F.transform(codes, lambda x, i: F.coalesce((F.get(codes, i - 1) - m["mean"]) * (x - m["mean"]), F.lit(0.0))), F.lit(0.0), lambda a, x: a + x)
    z3 = F.when(squares > 0, F.abs(products / F.greatest(squares, F.lit(1e-9)) + 1 / n) * F.sqrt(n)).otherwise(F.lit(9.0))
    random = F.least(F.lit(1.0), 3 * F.least(_below(-z1), 2 * _below(-z2), 2 * _below(-z3)))
    length = F.array_max(F.array(*[F.when(n >= x, F.lit(i)).otherwise(-1) for i, x in enumerate(LENGTHS)]))
    return F.struct(m["start"].alias("start"), m["end"].alias("end"), length.alias("length"), text_like.alias("text_like"), random.alias("random"))


def find_secrets(docs: DataFrame, rate: float = 0.01, alpha: float = 0.01) -> DataFrame:
    """Per row of ``docs`` (doc_id, text; other columns are ignored): doc_id and the arrays assign, access, hex and random of (start, end) in code points, end exclusive.

    random: tokens of 20 and more characters of two kinds at least (small letters, capitals, digits), with the other spans
    blanked out, that pass the randomness battery at level ``alpha`` and for which "ordinary text" is rejected. Within each class of
    lengths rejections hold a false-discovery rate of ``rate`` over all tokens of the corpus (Benjamini and Hochberg, over a
    histogram of 401 bins of log p). Null texts are empty. Repeated rows are scanned each. Time is in proportion to the length
    of texts and tokens, and near the number of spans. Tokens that tie in p stand or fall together.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    t = F.col("text")
    value = lambda x: F.length(F.regexp_extract(x["text"], ASSIGN, 2)) >= 12
    assign = _where(t.rlike("(?i:passw|secret|token|api_?key)"), F.filter(matches(t, ASSIGN), value), _SPAN)
    named = lambda x: F.length(F.regexp_extract(x, ASSIGN, 2)) >= 12
    rest = let(blanked(t, ASSIGN, named), lambda x: let(blanked(x, ACCESS), lambda y: let(blanked(y, HEX), lambda z: matches(z, TOKEN))))
    rows = rows.select("doc_id", "text", assign.alias("assign"), _where(t.contains("AKIA"), matches(t, ACCESS), _SPAN).alias("access"), _where(t.rlike(HEX), matches(t, HEX), _SPAN).alias("hex"), _where(t.rlike(TOKEN), rest, _SPAN).alias("tokens"))
    kinds = lambda x: sum((x["text"].rlike(c).cast("int") for c in ("[0-9]", "[A-Z]", "[a-z]")), F.lit(0))
    fit = lambda x: (kinds(x) >= 2) & ~(x["text"].rlike("[+/]") & x["text"].rlike("[_-]"))
    rows = rows.withColumn("tokens", F.filter("tokens", fit)).withColumn("tokens", F.transform("tokens", _measured)).withColumn("tokens", F.transform("tokens", _tested))
    spans = lambda name: F.transform(name, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias(name)
    rows = cut(rows.select("doc_id", spans("assign"), spans("access"), spans("hex"), "tokens"))
    limits = _limits(rows, rate)
    limit = lambda x: F.element_at(F.array(*[F.lit(y) for y in limits]), x["length"] + 1)
    found = F.filter("tokens", lambda x: (x["text_like"] <= limit(x)) & (x["random"] >= alpha))
    return rows.select("doc_id", "assign", "access", "hex", F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("random"))


def _limits(rows: DataFrame, rate: float) -> list[float]:
    """For each class of lengths the largest bin edge p with p <= rate * (tokens at or below p) / tokens; -1 if there is none."""
    p = rows.select(F.explode("tokens").alias("x")).select("x.length", "x.text_like").where("text_like is not null")
    bins = p.groupBy("length", F.least(F.lit(BINS), F.floor(-20 * F.log10(F.greatest("text_like", F.lit(1e-300))))).alias("bin")).agg(F.count("*").alias("n"))
    edge = F.pow(F.lit(10.0), -F.col("bin") / 20)
    from_below = Window.partitionBy("length").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)  # 401 bins
    everywhere = Window.partitionBy("length")
    passed = bins.select("length", edge.alias("edge"), F.sum("n").over(from_below).alias("r"), F.sum("n").over(everywhere).alias("m")).where(F.col("edge") <= rate * F.col("r") / F.col("m"))
    tops = {r["length"]: float(r["edge"]) for r in passed.groupBy("length").agg(F.max("edge").alias("edge")).collect()}
    return [tops.get(i, -1.0) for i in range(len(LENGTHS))]


def secret_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans from the arrays of find_secrets. Spans are kind:start:end, ordered by start, then assign, access, hex, random."""
    kinds = ("assign", "access", "hex", "random")

    def tagged_as(kind):
        text = lambda x: F.concat_ws(":", F.lit(kind), x["start"].cast("string"), x["end"].cast("string"))
        return F.transform(kind, lambda x: F.struct(x["start"].alias("start"), F.lit(kinds.index(kind)).alias("rank"), text(x).alias("s")))

    def joined(*names):
        tagged = F.concat(*[tagged_as(k) for k in names])
        return F.array_join(F.transform(F.array_sort(tagged), lambda x: x["s"]), ",")

    size = lambda k: F.size(k).cast("long").alias(f"n_{k}")
    return found.select("doc_id", size("assign"), size("access"), size("hex"), F.sha2(joined(*kinds[:3]), 256).alias("base_sha256"), joined(*kinds).alias("spans"))
