"""Personal data in whole texts, with DataFrame functions only.

Base spans come from exact patterns and checks.  Further candidates come from
looser patterns on what the base spans leave; gradient-boosted trees over the
candidates' format and context, compiled to SQL expressions, select those whose
score passes their kind's calibrated threshold.
"""

from __future__ import annotations

import re
import string
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: The kinds with base patterns, and credentials, which only the trees find.
ALL_KINDS = (*KINDS, "secret")

#: The base patterns.  Possessive forms of the plain ones: what follows a class
#: is never in it, so they match the same spans without deep recursion; a start
#: inside a run that failed from its beginning cannot match and is skipped.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this character class has no match of the kind.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

#: Looser patterns: spelled-out or spaced addresses, other separators, no plus;
#: unbroken runs with a digit or of many capitals, which may be credentials.
LOOSE = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:\x20?[\[({<]\x20?(?:at|@)\x20?[\])}>]\x20?|\x20at\x20|\x20?@\x20?)"
             r"[A-Za-z0-9-]{1,63}(?:(?:\x20?[\[({<]\x20?(?:dot|\.)\x20?[\])}>]\x20?|\x20dot\x20|\x20?\.)[A-Za-z0-9-]{1,63}){1,6}",
    "ip": r"(?<![0-9.])[0-9]{1,4}(?:\x20?(?:\.|\[\.\]|\(\.\)|\x20dot\x20)\x20?[0-9]{1,4}){3}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20._/ -]{0,2}[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z]|[0-9][ ./-])(?:\+|00)?[(]?[0-9](?:[\x20(). /-]{0,2}[0-9]){6,14}(?![ ./-]?[0-9]|[A-Za-z])",
    "secret": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9]|[A-Z]{16})[A-Za-z0-9+/_-]{8,}+={0,2}",
}
LOOSE_NEEDS = {"email": r"(?i)@|\bat\b", "ip": "[0-9][^0-9]", "card": "[0-9]", "phone": "[0-9]", "secret": "[0-9]|[A-Z]{16}"}
#: How the keys of well-known issuers begin (fixed values).
ISSUED = r"^(?:AKIA|ASIA|AIza|ghp_|gho_|glpat-|github_pat_|sk-|sk_live_|pk_live_|xox[abp]-)"

#: Words before a span that speak for a kind (fixed values, four languages).
CUES = {
    "email": r"(?i)(?:e-?mail|mail|contact|write|reach|correo|courriel|adresse)\W{0,4}(?:\w{1,3}\W{0,2})?$",
    "ip": r"(?i)(?:\bip|host|server|address|from|addr|ipv4|login)\W{0,4}(?:\w{1,3}\W{0,2})?$",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit|karte|tarjeta|carte|payment)\W{0,4}(?:\w{1,6}\W{0,2})?$",
    "phone": r"(?i)(?:phone|tel|call|mobile|cell|fax|whatsapp|telefon|tel.fono|t.l|number|ring|dial|sms)\W{0,4}(?:\w{1,3}\W{0,2})?$",
    "secret": r"(?i)(?:token|secret|passw(?:or)?d|passwd|pwd|api.?key|access.?key|auth\w{0,14}|bearer|credentials?|\bkey)[\"']?\W{0,4}$",
    "other": r"(?i)(?:version|v|order|invoice|isbn|issn|id|serial|ref|section|page|chapter|no|sku|build|ticket|price|\$)\W{0,3}$",
}
CONTEXT = 24
CHUNK = 256


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running_total(numbers: Column) -> Column:
    """Sums up to and including each element, in chunks, so that a long array
    costs little more than its length."""
    def sums(parts):
        chunk = lambda c: F.slice(numbers, c * CHUNK + 1, F.lit(CHUNK))
        grow = lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
        totals = F.transform(parts, lambda c: F.aggregate(chunk(c), F.lit(0), lambda a, x: a + x))
        return let(F.aggregate(totals, F.array(F.lit(0)), grow), lambda starts: F.flatten(F.transform(
            parts, lambda c: F.slice(F.aggregate(chunk(c), F.array(F.get(starts, c)), grow), 2, CHUNK))))
    empty = F.array().cast("array<int>")
    return F.when(F.size(numbers) == 0, empty).otherwise(
        sums(F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / CHUNK).cast("int"))))


def spans(text: Column, pattern: str, needs: str) -> Column:
    """Array of (start, end, value, before, after) of a pattern's leftmost
    non-overlapping matches; positions in code points, end exclusive.

    The text between the matches gives the positions: both arrays come from
    the same scan order.
    """
    p = F.lit(pattern)

    def placed(hits):
        def with_gaps(gaps):
            step = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.length(g) + F.length(h))
            return let(running_total(step), lambda ends: F.transform(hits, lambda h, i: F.struct(
                (F.get(ends, i) - F.length(h)).alias("start"), F.get(ends, i).alias("end"), h.alias("value"),
                F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"),
                F.left(F.get(gaps, i + 1), F.lit(CONTEXT)).alias("after"))))
        return F.when(F.size(hits) > 0, let(F.split(text, pattern, -1), with_gaps))

    kind = "array<struct<start:int,end:int,value:string,before:string,after:string>>"
    found = F.when(text.rlike(needs), let(F.regexp_extract_all(text, p, F.lit(0)), placed))
    return F.coalesce(found, F.array().cast(kind))


def luhn_ok(value: Column) -> Column:
    return F.call_function("luhn_check", value)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(kind: str, value: Column) -> Column:
    """The check that a base match of a kind has to pass."""
    n = F.length(digits(value))
    if kind == "ip":
        return value.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$")
    if kind == "card":
        return F.when((n >= 13) & (n <= 19), luhn_ok(digits(value))).otherwise(False)
    if kind == "phone":
        return (n >= 9) & (n <= 15)
    return F.lit(True)


def plausible(kind: str, value: Column) -> Column:
    """The number check that a looser candidate has to pass as well."""
    if kind == "ip":
        return F.forall(F.filter(F.split(value, "[^0-9]+"), lambda g: g != ""), lambda g: g.rlike(rf"^{OCTET}$"))
    return valid(kind, value)


def base_spans(text: Column, kind: str) -> Column:
    return F.filter(spans(text, BASE[kind], NEEDS[kind]), lambda s: valid(kind, s["value"]))


def masked(text: Column, kind: str) -> Column:
    """The text with the valid base matches of a kind blanked out, as long as
    before."""
    def blank(hits):
        cover = lambda h: F.when(valid(kind, h), F.repeat(F.lit("\x00"), F.length(h))).otherwise(h)
        joined = lambda gaps: F.concat(F.array_join(F.zip_with(
            F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.concat(g, cover(h))), ""), F.element_at(gaps, -1))
        return F.when(F.size(hits) > 0, let(F.split(text, BASE[kind], -1), joined))
    found = F.when(text.rlike(NEEDS[kind]), let(F.regexp_extract_all(text, F.lit(BASE[kind]), F.lit(0)), blank))
    return F.coalesce(found, text)


def features(kind: Column, value: Column, before: Column, after: Column) -> Column:
    """Format and context of a candidate as an array of doubles."""
    d = digits(value)
    n = F.length(d)
    share = lambda c: c / F.greatest(F.length(value), F.lit(1))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    groups = F.filter(F.split(value, "[^0-9]+"), lambda g: g != "")
    parts = [
        *[flag(kind == k) for k in ALL_KINDS],
        n.cast("double"), F.length(value).cast("double"), F.size(groups).cast("double"),
        F.coalesce(F.length(F.get(groups, F.lit(0))), F.lit(0)).cast("double"),
        F.coalesce(F.length(F.try_element_at(groups, F.lit(-1))), F.lit(0)).cast("double"),
        flag(value.startswith("+") | value.startswith("00")), flag(value.contains("(")), flag(value.contains("@")),
        flag(value.rlike(r"(?i)[\[({<]\s?(?:at|@|dot|\.)\s?[\])}>]")), flag(value.rlike(r"(?i)\x20(?:at|dot)\x20")),
        flag(value.rlike(r"(?i)(?:\.|dot[\])}>]?)\s?[a-z]{2,6}$")),
        flag(value.rlike(r"(?i)\b(?:com|org|net|edu|gov|io|info|biz|de|fr|es|uk|eu|us|co)$")),
        flag(F.when((n >= 13) & (n <= 19), luhn_ok(d))), flag(d.rlike("^[3-6]")),
        flag(F.size(groups) == 4) * flag(F.forall(groups, lambda g: g.try_cast("int") <= 255)),
        flag(d.rlike(r"^(.)\1+$")), flag(value.contains(".")), flag(value.contains(",")), flag(value.contains("/")),
        flag(value.rlike(r"^(?:19|20)[0-9]{2}[-/. ](?:0?[1-9]|1[0-2])[-/. ]")),
        flag(value.rlike(r"^[0-3]?[0-9][-/. ][01]?[0-9][-/. ](?:19|20)?[0-9]{2}$")),
        flag(before.rlike(r"[0-9A-Za-z]$")), flag(after.rlike("^[0-9A-Za-z]")),
        *[flag(before.rlike(c)) for c in CUES.values()],
        # of runs that may be credentials: mixture of characters, how word-like
        share(n), share(F.size(F.array_distinct(F.split(value, "")))),
        share(F.size(F.regexp_extract_all(value, F.lit("[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])"), F.lit(0)))),
        F.array_max(F.transform(F.split(value, "[^A-Za-z]+"), lambda w: F.length(w))).cast("double"),
        flag(value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")), flag(value.rlike("[a-z]") & value.rlike("[A-Z]")),
        flag(value.rlike("[/_-]")), flag(value.rlike(ISSUED)), flag(before.rlike("[=:]\\s?[\"']?$")),
    ]
    return F.array(*parts)


# -- training ---------------------------------------------------------------

#: Training formats: (kind, label, template).  d a digit, D one from 2 to 9, o a
#: number to 255, O one from 256 to 999, a a letter, L a capital, x and X a
#: hexadecimal digit, m a letter or digit; card templates get a last digit that
#: makes them pass (label 1) or fail Luhn's check.
TEMPLATES = [
    ("email", 1, "aaaa.aaa (at) aaaaaa (dot) com"), ("email", 1, "aaaaa [at] aaaaaaa [dot] org"),
    ("email", 1, "aaaaadd at aaaaaaa dot com"), ("email", 1, "aaa_aaaa(at)aaaa.net"), ("email", 1, "aaaaaa @ aaaaaaa.com"),
    ("email", 1, "aaa.aaaaa [at] aaaa.aaaaa.com"), ("email", 1, "aaaaaa@ aaaaaa .de"), ("email", 1, "aaaa{at}aaaaaa{dot}net"),
    ("email", 0, "aaaaa at aaaa.aaa"), ("email", 0, "aaaa at aaaaaaa.aaaaaa"), ("email", 0, "aaaaaa at aaa dot aaaaaaa"),
    ("email", 0, "aaa @ aaaaa.aaaaaaaa"), ("email", 0, "aaaaa at d.d"), ("email", 0, "dd @ d.dd"), ("email", 0, "aaaa at aaaaa.aaaa"),
    ("ip", 1, "o[.]o[.]o[.]o"), ("ip", 1, "o . o . o . o"), ("ip", 1, "o.o.o[.]o"), ("ip", 1, "o(.)o(.)o(.)o"),
    ("ip", 1, "o dot o dot o dot o"),
    ("ip", 0, "O.O.O.O"), ("ip", 0, "d, d, d, d"), ("ip", 0, "o, o, O, o"), ("ip", 0, "O.o.o.O"), ("ip", 0, "dddd.dd.dd.d"),
    ("card", 1, "4ddd.dddd.dddd.dddd"), ("card", 1, "5ddd  dddd  dddd  dddd"), ("card", 1, "4ddd_dddd_dddd_dddd"),
    ("card", 1, "3ddd/dddddd/ddddd"), ("card", 1, "6ddd. dddd. dddd. dddd"),
    ("card", 0, "4ddd.dddd.dddd.dddd"), ("card", 0, "dddddddddddddddd"), ("card", 0, "dd.dd.dddd dd.dd.dddd"),
    ("card", 0, "dddd dddd dddd dddd"), ("card", 0, "ddddddddddddd"), ("card", 0, "d.d.d.d.d.d.d.d.d.d.d.d.d.d"),
    ("phone", 1, "(Ddd) Ddd-dddd"), ("phone", 1, "Ddd-Ddd-dddd"), ("phone", 1, "Ddd.Ddd.dddd"), ("phone", 1, "00dd ddd ddd dddd"),
    ("phone", 1, "0dd ddd dd dd"), ("phone", 1, "1-Ddd-Ddd-dddd"), ("phone", 1, "0d dd dd dd dd"), ("phone", 1, "0ddd/ddddddd"),
    ("phone", 1, "(0dd) dddd dddd"),
    ("phone", 0, "20dd-0d-1d"), ("phone", 0, "1d.0d.20dd"), ("phone", 0, "dddddddd"), ("phone", 0, "dddddddddddd"),
    ("phone", 0, "ddd ddd ddd"), ("phone", 0, "d.ddd.ddd.ddd"), ("phone", 0, "19dd-20dd"), ("phone", 0, "dd/dd/20dd"),
    ("phone", 0, "ddddd-dddd"), ("phone", 0, "978-d-dd-dddddd-d"), ("phone", 0, "d d d d d d d"), ("phone", 0, "dddddddddddddddd"),
    ("phone", 0, "20dd.dd.dd.dd"), ("phone", 0, "dddd dddd"),
]
#: Credentials: (label, contexts, template).
CREDENTIALS = [
    (1, "cue", "x" * 40), (1, "cue", "x" * 32), (1, "cue", "x" * 18), (1, "cue", "X" * 40), (1, "cue", "x" * 64), (1, "cue", "m" * 12),
    (1, "cue", "m" * 20), (1, "cue", "m" * 24), (1, "cue", "m" * 40), (1, "cue", "mmmmmmmm-mmmmmmmm-mmmmmmmm"), (1, "cue", "mmmmmm/mmmmmmmm+mmmmmmm="),
    (1, "any", "AKIA" + "L" * 7 + "D" + "L" * 8), (1, "any", "AKIA" + "L" * 16), (1, "any", "AKIA" + "LLLD" * 4), (1, "any", "ASIA" + "LLDL" * 4),
    (1, "any", "ghp_" + "m" * 36), (1, "any", "sk-" + "m" * 32), (1, "any", "glpat-" + "m" * 20), (1, "any", "xoxb-dddddddddd-" + "m" * 24),
    (0, "plain", "x" * 40), (0, "plain", "x" * 32), (0, "plain", "x" * 64), (0, "plain", "X" * 32), (0, "plain", "m" * 20), (0, "plain", "m" * 12),
    (0, "plain", "xxxxxxxx-xxxx-xxxx-xxxx-xxxxxxxxxxxx"), (0, "any", "20dd-0d-1d"), (0, "any", "20ddddddTdddddd"), (0, "any", "ddddddddddddddd"),
    (0, "any", "dddddddd"), (0, "any", "d" * 16), (0, "any", "d" * 12), (0, "any", "d" * 20), (0, "any", "ddd-ddd-dddd"), (0, "any", "aaaaaaaaaaad"), (0, "any", "aaaaaaaadd"), (0, "any", "aaaa-aaaaaa-dd"),
    (0, "any", "aaaa_aaaaaa_d"), (0, "any", "LLLLL-dd-aaaaaaa"), (0, "any", "LL-dddd-dd"), (0, "any", "L" * 16), (0, "any", "L" * 22),
    (0, "any", "aaaa/aaaaaa/d"), (0, "any", "Laaaaaaaaaa-dd"), (0, "any", "ddaa-aaaaaaa"),
]
CREDENTIAL_CONTEXTS = {
    "cue": ["password=", "password: ", "token = \"", "TOKEN = \"", "api_key='", "secret: ", "Bearer ", "access key is ", "pwd="],
    "plain": ["commit ", "sha256 ", "and ", "", ". ", "md5: ", "checksum=", "id: ", "ref. "],
    "any": ["and ", "the ", "", ", ", ". ", "key: ", "token = \"", "id: ", "with ", "call ", "host ", "card ", "e-mail "],
}
ROWS_PER_TEMPLATE = 80
#: Context before a training span: cue words of its kind, neutral or misleading.
BEFORE = {1: {"email": ["email: ", "contact me: ", "write to ", "and ", "", ". "], "ip": ["ip ", "host ", "from ", "and ", "", "server: "],
              "card": ["card ", "visa: ", "my card number is ", "and ", "", "credit card: "],
              "phone": ["phone: ", "call ", "tel. ", "call me at ", "my number: ", "Tel "]},
          0: {k: ["order ", "version ", "and ", "the ", "", "section ", "ref. ", "id: "] for k in KINDS}}
#: Share of negatives that a kind's threshold lets pass at most.
PASS_NEGATIVES = 0.005
TREES, DEPTH = 16, 4


def training_formats(kinds: tuple[str, ...]) -> list[tuple[str, int, str, list[str]]]:
    """(kind, label, template, contexts) of the formats of ``kinds``."""
    formats = [(k, label, t, BEFORE[label][k]) for k, label, t in TEMPLATES if k in kinds]
    if "secret" in kinds:
        formats += [("secret", label, t, CREDENTIAL_CONTEXTS[c]) for label, c, t in CREDENTIALS]
    return formats


def training_candidates(spark: SparkSession, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """``(id, kind, label, features)``: candidates of known kind, generated from
    the formats by hashes of their numbers."""
    formats = training_formats(kinds)
    rows = spark.range(0, len(formats) * ROWS_PER_TEMPLATE, 1, 1)
    at = (F.col("id") % len(formats) + 1).cast("int")
    # lists as one string each: a literal per item is a call to the JVM per item
    pick = lambda items: F.element_at(F.split(F.lit("\x1f".join(items)), "\x1f", -1), at)
    kind, label = pick([t[0] for t in formats]), pick([str(t[1]) for t in formats]).cast("int")
    number = lambda i, lo, hi: (F.lit(lo) + F.pmod(F.xxhash64(F.col("id"), i), F.lit(hi - lo))).cast("string")
    one_of = lambda letters, i: F.substr(F.lit(letters), F.pmod(F.xxhash64(F.col("id"), i), F.lit(len(letters))).cast("int") + 1, F.lit(1))
    lower, upper = string.ascii_lowercase, string.ascii_uppercase
    # words of a template that stand for themselves
    words = F.split(F.regexp_replace(F.regexp_replace(F.col("template"), "dot", "\x01"), r"(?<![a-z])at(?![a-z])", "\x02"), "")
    char = lambda c, i: (F.when(c == "d", number(i, 0, 10)).when(c == "D", number(i, 2, 10)).when(c == "o", number(i, 0, 256))
                         .when(c == "O", number(i, 256, 1000)).when(c == "a", one_of(lower, i)).when(c == "L", one_of(upper, i))
                         .when(c == "x", one_of("0123456789abcdef", i)).when(c == "X", one_of("0123456789ABCDEF", i))
                         .when(c == "m", one_of(string.digits + upper + lower, i)).when(c == "\x01", "dot").when(c == "\x02", "at")
                         .otherwise(c))
    tails = re.compile(r"\b(?:com|org|net|de)$")
    ends = pick([(m[0] if (m := tails.search(t[2])) else "") for t in formats])
    stems = pick([tails.sub("", t[2]) for t in formats])
    filled = F.concat(F.array_join(F.transform(words, char), ""), F.col("tail"))
    luhn = lambda v: F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: F.concat(F.expr("left(filled, length(filled) - 1)"), k.cast("string"))),
                              lambda w: luhn_ok(digits(w)) == (F.col("label") == 1))
    made = (rows.select("id", kind.alias("kind"), label.alias("label"), stems.alias("template"), ends.alias("tail"))
            .withColumn("filled", filled)
            .withColumn("value", F.when(F.col("kind") == "card", F.coalesce(F.get(luhn(F.col("filled")), F.lit(0)), "filled"))
                        .otherwise(F.col("filled"))))
    contexts = F.split(pick(["\x1e".join(t[3]) for t in formats]), "\x1e", -1)
    before = F.element_at(contexts, (F.pmod(F.xxhash64(F.lit("before"), "id"), F.size(contexts)) + 1).cast("int"))
    # kept apart, or the optimizer writes value and before out in every feature
    made = made.select("id", "kind", F.col("label").cast("double").alias("label"), "value", before.alias("before")).cache()
    return made.select("id", "kind", "label", features(F.col("kind"), F.col("value"), F.col("before"), F.lit(" ")).alias("features"))


def _tree(debug: str) -> str:
    """A regression tree, as printed by Spark, as a nested SQL CASE over the
    array ``x``."""
    lines = [line.strip() for line in debug.split("\n") if re.match(r"\s*(If|Else|Predict)", line)]
    at = 0

    def node() -> str:
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict"):
            return f"{float(line.split(':')[1])!r}D"
        feature, bound = re.match(r"If \(feature (\d+) <= ([-\d.eE]+)\)", line).groups()
        yes = node()
        at += 1  # the Else line
        return f"CASE WHEN x[{feature}] <= {float(bound)!r}D THEN {yes} ELSE {node()} END"

    return node()


class PiiModel:
    """Boosted trees over ``features`` and a score threshold per kind that they
    were fitted for."""

    def __init__(self, trees: list[str], weights: list[float], thresholds: dict[str, float]):
        self.trees, self.weights, self.thresholds = trees, weights, thresholds

    def score(self, x: Column) -> Column:
        total = " + ".join(f"({_tree(t)}) * {w!r}D" for t, w in zip(self.trees, self.weights))
        return F.get(F.call_function("transform", F.array(x), F.expr(f"x -> {total}")), F.lit(0))

    def selects(self, kind: Column, x: Column) -> Column:
        bound = reduce(lambda rest, k: F.when(kind == k, F.lit(self.thresholds[k])).otherwise(rest), self.thresholds, F.lit(0.0))
        return self.score(x) > bound


def fit_pii(spark: SparkSession, kinds: tuple[str, ...] = KINDS) -> PiiModel:
    """Boosted trees for ``kinds`` (of ALL_KINDS) by Spark ML on four fifths of the generated candidates; the
    other fifth sets each kind's threshold, which at most PASS_NEGATIVES of its
    negatives pass."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    rows = training_candidates(spark, kinds).cache()
    vectors = rows.withColumn("x", array_to_vector("features"))
    held = F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(5)) == 0
    model = GBTClassifier(featuresCol="x", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7,
                          cacheNodeIds=False).fit(vectors.filter(~held))
    fitted = PiiModel([t.toDebugString for t in model.trees], list(model.treeWeights), dict.fromkeys(kinds, 0.0))
    scored = rows.filter(held & (F.col("label") == 0)).withColumn("score", fitted.score(F.col("features")))
    for r in scored.groupBy("kind").agg(F.percentile("score", 1 - PASS_NEGATIVES).alias("t")).collect():
        fitted.thresholds[r["kind"]] = max(0.0, r["t"])
    rows.unpersist()
    return fitted


# -- the operator -----------------------------------------------------------

def find_pii(docs: DataFrame, model: PiiModel, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and ``base`` and ``added``: arrays of (kind, start,
    end, value) by kind in ALL_KINDS order, then start.

    base holds the exact matches; added holds further spans outside of them that
    the trees select, of the kinds that the model was fitted for.  A NULL or empty text has none.  No shuffle: each row is
    settled by itself, so repeated rows and ids stay as they are.
    """
    src = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    text = F.col("__text")
    named = lambda kind, found: F.transform(found, lambda s: F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))

    def is_plausible(kind):
        return lambda s: plausible(kind, s["value"])

    def of_kind(kind):
        return lambda s: s.withField("kind", F.lit(kind))

    def candidates(rest):
        found = [F.transform(F.filter(spans(rest, LOOSE[k], LOOSE_NEEDS[k]), is_plausible(k)),
                             of_kind(k)) for k in model.thresholds]
        return F.filter(F.concat(*found), lambda s: let(
            features(s["kind"], s["value"], s["before"], s["after"]), lambda x: model.selects(s["kind"], x)))

    def blanked(kind):
        return lambda t: masked(t, kind)

    rest = text
    for kind in KINDS:
        rest = let(rest, blanked(kind))
    might = text.rlike(r"(?i)[0-9]|@|\bat\b|(?-i:[A-Z]{16})")
    base = F.concat(*[named(k, base_spans(text, k)) for k in KINDS])
    added = F.transform(let(rest, candidates), lambda s: F.struct(s["kind"], s["start"], s["end"], s["value"]))
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")
    return src.select(*keep, F.when(might, base).otherwise(empty).alias("base"),
                      F.when(might, added).otherwise(empty).alias("added"))


def redact(docs: DataFrame, model: PiiModel, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of its texts replaced by ``<KIND>``; overlapping
    spans are replaced from the leftmost, each up to the next one's start.  A NULL
    text stays NULL; other columns, of any name, pass through."""
    # the row goes along as one struct: its columns may be named like the new ones
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text"))
    found = find_pii(rows, model, ["row", "text"], "text")
    spans_ = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    t = F.coalesce("text", F.lit(""))

    def step(acc, s):
        gap = F.greatest(s["start"] - acc["at"], F.lit(0))
        return F.struct(F.concat(acc["out"], F.substr(t, acc["at"] + 1, gap), F.lit("<"), F.upper(s["kind"]), F.lit(">")).alias("out"),
                        F.greatest(acc["at"], s["end"]).alias("at"))
    done = F.aggregate(spans_, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step,
                       lambda a: F.concat(a["out"], F.substr(t, a["at"] + 1)))
    new = F.when(F.size(spans_) > 0, done).otherwise(F.col("text"))
    return found.select(*[new.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def spans_text(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def in_order(found: Column) -> Column:
    """Spans by kind in ALL_KINDS order, then start, then end."""
    rank = F.transform(found, lambda s: F.struct(
        F.array_position(F.array(*[F.lit(k) for k in ALL_KINDS]), s["kind"]).alias("k"),
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value")))
    return F.array_sort(F.array_distinct(rank))
