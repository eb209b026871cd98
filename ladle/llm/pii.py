"""Personal data by weak supervision, in DataFrame functions only.

Candidate spans come from regular expressions: the four base kinds, whose valid matches always stay, and three looser
kinds. Five labelers vote on every candidate (shape, gazetteer, left context, edges, variety of characters), or abstain.
Votes are counted per (kind, votes, traits of the span) in one aggregate; that table has at most ``MOST_PATTERNS`` rows however
large the corpus is, and is all that reaches the driver. Expectation-maximisation over the votes estimates how reliable each
labeler is and how likely each pattern is personal data; a logistic span classifier on votes and traits (length, share of digits,
both cases) is then trained on those soft labels, and its decision is applied to every candidate of the looser kinds.

Defined cases: a null or empty text has no spans; repeated rows are judged alike; nothing is looked up by doc_id, so
null or repeated ids do no harm; extra columns are ignored by :func:`report` and kept by :func:`redact` (give candidates another
``name`` where ``_cands`` is taken). Offsets are code points, ends exclusive. Patterns are linear in the text: loops are possessive
and starts are guarded. Of n matches in one text, places, overlaps and the redacted text take n log n steps.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOCAL = "A-Za-z0-9._%+-"
#: Kind -> pattern. The first four find the base kinds; the others propose spans for the classifier.
KINDS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{20,}+",
    "local_phone": r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
BASE = ("email", "ip", "card", "phone")
LABELERS = ("shape", "gazetteer", "context", "edges", "variety")
VOTES = len(LABELERS)
MOST_PATTERNS = (len(BASE) + 3 * 3 * 2 * (len(KINDS) - len(BASE))) * 3 ** VOTES
#: A text is cut into blocks of ``2 ** _BLOCK_BITS`` code points where spans are replaced.
_BLOCK_BITS = 9
#: Words that speak for personal data just before a span, and words that speak against it.
FOR = r"(?i)(?:token|key|secret|password|passwd|pwd|api|auth|bearer|call|tel|phone|mobile|fax|mail|contact|ssn|id|card|account|ip|address)\W{0,6}$"
AGAINST = r"(?i)(?:version|chapter|page|figure|table|isbn|issn|sha256|sha1|md5|commit|checksum|digest|hash|build|part|no)\W{0,6}$"
# Top-level names; openings of issued access tokens; digests of nothing; fillers.
TOP_NAMES = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "it", "nl", "eu")
TOKEN_OPENINGS = ("AKIA", "ASIA", "AIza", "ya29", "eyJ", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "hf_", "npm_", "pypi-", "sk-", "sk_live_", "rk_live_", "xoxb-", "xoxp-")
DIGESTS_OF_NOTHING = ("d41d8cd98f00b204", "da39a3ee5e6b4b0d", "e3b0c44298fc1c14", "cf83e1357eefb8bd")
FILLERS = r"(?i)(?:0000|1234567|xxxx|aaaa|abcdef|example|changeme|placeholder)"
# Area codes of large cities; codes the numbering plan never gives out, and lines it keeps for fiction; void identity numbers.
CITY_CODES = ("201", "202", "203", "206", "210", "212", "213", "214", "215", "216", "301", "303", "305", "310", "312", "313", "314", "323", "347", "404", "408", "412", "415",
              "416", "469", "503", "504", "510", "512", "514", "602", "604", "612", "614", "615", "617", "619", "646", "650", "702", "703", "704", "713", "716", "718",
              "720", "757", "773", "801", "804", "808", "813", "816", "818", "832", "858", "901", "904", "908", "914", "916", "917", "925", "949", "954", "972")
NEVER_CODES = r"^\(?(?:[01]|[2-9]9|[2-9]11|37|96)"
FICTION_LINES = r"^\(?[0-9]{3}\)?[ .-](?:[01]|555[ .-]01)"
VOID_IDS = r"^(?:000|666|9|078-05-1120|219-09-9999|457-55-5462)|-00-|-0000$"
_SPAN = "struct<start:int,end:int,kind:string,ord:int,text:string,left:string,right:string>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(numbers: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running totals of an array of numbers from 0 on, by doubling: n elements take log n passes and no copies that grow."""
    return _let(numbers, lambda xs: F.aggregate(
        F.filter(F.array(*[F.lit(1 << k) for k in range(31)]), lambda step: step < F.size(xs)), xs,
        lambda acc, step: F.transform(acc, lambda x, i: join(x, F.coalesce(F.get(acc, i - step), F.lit(0))))))


def _luhn(digits: Column) -> Column:
    each = F.reverse(F.filter(F.split(digits, ""), lambda x: x != ""))
    doubled = F.transform(each, lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise(
        x.cast("int") * 2 - F.when(x.cast("int") > 4, F.lit(9)).otherwise(F.lit(0))))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: Column, text: Column) -> Column:
    """Whether a match of a base kind counts."""
    digits = F.regexp_replace(text, "[^0-9]", "")
    part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})?"
    return (F.when(kind == "email", F.lit(True))
            .when(kind == "ip", text.rlike(rf"^{part}\.{part}\.{part}\.{part}$"))
            .when(kind == "card", F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False)))
            .when(kind == "phone", F.length(digits).between(9, 15))
            .otherwise(F.lit(False)))


def spans(text: Column, kind: str) -> Column:
    """All matches of a kind with code point offsets and a little of the text on both sides."""
    pattern = KINDS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    ordinal = list(KINDS).index(kind)
    zipped = F.zip_with(found, F.zip_with(gaps, F.slice(gaps, 2, 1 << 30), lambda a, b: F.struct(a.alias("l"), b.alias("r"))),
                        lambda m, g: F.struct(m.alias("m"), g["l"].alias("l"), g["r"].alias("r")))
    zipped = F.filter(zipped, lambda z: z["m"].isNotNull())

    def placed(pairs):
        ends = _running(F.transform(pairs, lambda z: F.length(z["l"]) + F.length(z["m"])), lambda x, y: x + y)
        return F.zip_with(pairs, ends, lambda z, end: F.struct(
            (end - F.length(z["m"])).alias("start"), end.alias("end"), F.lit(kind).alias("kind"), F.lit(ordinal).alias("ord"), z["m"].alias("text"),
            F.right(z["l"], F.lit(24)).alias("left"), F.left(z["r"], F.lit(1)).alias("right")).cast(_SPAN))

    return F.when(text.rlike(pattern), _let(zipped, placed)).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit("1")).when(no, F.lit("0")).otherwise(F.lit("-"))


def votes(s: Column) -> Column:
    """One character for each labeler: 1 for, 0 against, - abstains."""
    kind, text = s["kind"], s["text"]
    base = kind.isin(*BASE)
    ok = valid(kind, text)
    digits = F.length(F.regexp_replace(text, "[^0-9]", ""))
    shape = _vote((base & ok) | ((kind == "secret") & text.rlike("^(?:[0-9a-f]{32,}|[0-9A-F]{32,}|[A-Za-z0-9_-]{24,})=*$"))
                  | ((kind == "local_phone") & text.rlike(r"^\(?[2-9]")) | ((kind == "national_id") & ~text.rlike("^(?:000|666|9)|-00-|-0000$")), F.lit(True))
    digests = "^(?i:" + "|".join(DIGESTS_OF_NOTHING) + ")"
    void = (((kind == "local_phone") & (text.rlike(NEVER_CODES) | text.rlike(FICTION_LINES))) | ((kind == "national_id") & text.rlike(VOID_IDS))
            | ((kind == "secret") & text.rlike(digests)) | ((kind != "email") & text.rlike(FILLERS)))
    listed = (((kind == "email") & text.rlike(r"\.(?:" + "|".join(TOP_NAMES) + ")$")) | ((kind == "secret") & text.rlike("^(?:" + "|".join(TOKEN_OPENINGS) + ")"))
              | ((kind == "local_phone") & text.rlike(r"^\(?(?:" + "|".join(CITY_CODES) + ")")))
    gazetteer = _vote(listed & ~void, void)
    context = _vote(s["left"].rlike(FOR), s["left"].rlike(AGAINST))
    edges = _vote(s["right"].rlike(r"^[\s\"',;:!?)]") | (s["right"] == ""), s["right"].rlike("^[A-Za-z0-9]"))
    share = digits / F.length(text)
    variety = _vote(F.when(kind == "secret", share.between(0.15, 0.9)).otherwise(F.size(F.array_distinct(F.split(text, ""))) >= 5),
                    F.when(kind == "secret", (share < 0.08) | (share > 0.95)).otherwise(F.size(F.array_distinct(F.split(text, ""))) <= 3))
    return F.concat(shape, gazetteer, context, edges, variety)


def traits(s: Column) -> Column:
    """What a span of a looser kind looks like, one character each: length, share of digits, both cases; nothing for the base kinds."""
    text, n = s["text"], F.length(s["text"])
    share = F.length(F.regexp_replace(text, "[^0-9]", "")) / n
    return F.when(s["kind"].isin(*BASE), F.lit("")).otherwise(F.concat(
        F.when(n < 24, "s").when(n < 40, "m").otherwise("l"), F.when(share < 0.3, "f").when(share < 0.7, "h").otherwise("d"),
        F.when(text.rlike("[a-z]") & text.rlike("[A-Z]"), "b").otherwise("o")))


def with_candidates(docs: DataFrame, name: str = "_cands") -> DataFrame:
    """docs and a column ``name``: every candidate span with its validity, votes and traits."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = F.when(text.rlike("[0-9@]"), F.concat(*[spans(text, k) for k in KINDS])).otherwise(F.array().cast(f"array<{_SPAN}>"))
    return docs.withColumn(name, F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), s["ord"].alias("ord"), s["end"].alias("end"), s["kind"].alias("kind"),
        valid(s["kind"], s["text"]).alias("base"), F.concat(votes(s), traits(s)).alias("votes"))))


def fit(candidates: DataFrame, rounds: int = 40, name: str = "_cands") -> list[str]:
    """The patterns ``kind:votes and traits`` that the trained classifier takes for personal data."""
    counted = (candidates.select(F.explode(name).alias("c")).groupBy(F.col("c.kind").alias("kind"), F.col("c.votes").alias("votes"))
               .agg(F.count("*").alias("n")).collect())  # at most MOST_PATTERNS rows
    table = sorted((r["kind"], r["votes"], r["n"]) for r in counted)
    return [f"{k}:{v}" for (k, v, _), p in zip(table, classify(table, expectation_maximisation(table, rounds))) if p >= 0.5]


def expectation_maximisation(table: list[tuple[str, str, int]], rounds: int = 40) -> list[float]:
    """Posterior of each vote pattern, given labelers that err independently within each class."""
    post = [min(0.95, max(0.05, 0.5 + 0.25 * (v[:VOTES].count("1") - v[:VOTES].count("0")))) for _, v, _ in table]
    for _ in range(rounds):
        prior = {}
        for kind in {k for k, _, _ in table}:
            own = [(p, n) for p, (k, _, n) in zip(post, table) if k == kind]
            prior[kind] = (1 + sum(p * n for p, n in own)) / (2 + sum(n for _, n in own))
        rate = []  # for each labeler: class -> vote -> probability, with one pseudo-count that favours truthful votes
        for j in range(len(LABELERS)):
            counts = {1: {"1": 3.0, "0": 1.0, "-": 2.0}, 0: {"1": 1.0, "0": 3.0, "-": 2.0}}
            for p, (_, v, n) in zip(post, table):
                counts[1][v[j]] += p * n
                counts[0][v[j]] += (1 - p) * n
            rate.append({c: {v: x / sum(by.values()) for v, x in by.items()} for c, by in counts.items()})
        fresh = []
        for kind, v, _ in table:
            odds = math.log(prior[kind] / (1 - prior[kind])) + sum(math.log(rate[j][1][x] / rate[j][0][x]) for j, x in enumerate(v[:VOTES]))
            fresh.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
        post = fresh
    return post


def classify(table: list[tuple[str, str, int]], soft: list[float], steps: int = 300, rate: float = 0.5) -> list[float]:
    """Logistic regression on kind, votes and, by kind, the traits of the span, fitted to the soft labels."""
    def features(kind, v):
        ballots, own = v[:VOTES], v[VOTES:]
        return [("kind", kind), *[(j, x) for j, x in enumerate(ballots) if x != "-"], ("for", ballots.count("1")), ("against", ballots.count("0")),
                *[(kind, j, x) for j, x in enumerate(own)]]

    rows = [features(k, v) for k, v, _ in table]
    weight, total = {}, sum(math.sqrt(n) for _, _, n in table) or 1.0
    for _ in range(steps):
        slope = {}
        for f, p, (_, _, n) in zip(rows, soft, table):
            miss = (p - 1 / (1 + math.exp(-sum(weight.get(x, 0.0) for x in f)))) * math.sqrt(n) / total
            for x in f:
                slope[x] = slope.get(x, 0.0) + miss
        for x, g in slope.items():
            weight[x] = weight.get(x, 0.0) * 0.9995 + rate * 4 * g
    return [1 / (1 + math.exp(-sum(weight.get(x, 0.0) for x in f))) for f in rows]


def _decided(accepted: list[str], name: str) -> Column:
    """The final spans, sorted: base ones, and accepted ones of other kinds that touch no base span.

    Base spans are laid out by start and the others among them by end; an other one is touched if a base span before it in this
    order reaches beyond its start.
    """
    chosen = F.filter(name, lambda c: c["base"] | (~c["kind"].isin(*BASE) & F.concat_ws(":", c["kind"], c["votes"]).isin(*accepted, "")))
    laid = F.array_sort(F.transform(chosen, lambda c: F.struct(
        F.when(c["base"], c["start"]).otherwise(c["end"]).alias("at"), c["base"].alias("base"),
        F.when(c["base"], c["end"]).otherwise(F.lit(0)).alias("to"), c.alias("span"))))

    def untouched(rows):
        reach = _running(F.transform(rows, lambda x: x["to"]), F.greatest)
        return F.filter(F.zip_with(rows, reach, lambda x, r: F.when(x["base"] | (r <= x["span"]["start"]), x["span"])), lambda c: c.isNotNull())

    return F.array_sort(_let(laid, untouched))


def _listed(spans_: Column) -> Column:
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(candidates: DataFrame, accepted: list[str], name: str = "_cands") -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, all spans."""
    d = candidates.select("doc_id", _decided(accepted, name).alias("s"))
    base = F.filter("s", lambda c: c["base"])

    def count(kind):
        return F.size(F.filter("s", lambda c: c["base"] & (c["kind"] == kind))).cast("long").alias(f"n_{kind}")

    n = [count(k) for k in BASE]
    return d.select("doc_id", *n, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("s")).alias("spans"))


def redact(candidates: DataFrame, accepted: list[str], name: str = "_cands") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; ``n_chars`` follows the new text.

    A span that begins inside an earlier one is covered by its brackets. The text is cut into blocks once, so that a piece is
    taken from the blocks it lies in and not counted off from the start of the text.
    """
    text = F.col("text")

    def piece(blocks, start, end):
        first = F.shiftright(start, _BLOCK_BITS)
        joined = F.array_join(F.slice(blocks, first + 1, F.shiftright(end, _BLOCK_BITS) - first + 1), "")
        return F.substr(joined, start - F.shiftleft(first, _BLOCK_BITS) + 1, end - start)

    def rewritten(found):
        def joined(reach, blocks):
            def one(s, i):
                before = F.coalesce(F.get(reach, i - 1), F.lit(0))
                return F.when(s["start"] >= before, F.concat(piece(blocks, before, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(F.lit(""))

            return F.concat(F.array_join(F.transform(found, one), ""), piece(blocks, F.element_at(reach, -1), F.length(text)))

        blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{1 << _BLOCK_BITS}}}"), F.lit(0))
        reach = _running(F.transform(found, lambda s: s["end"]), F.greatest)
        return F.when(F.size(found) > 0, _let(reach, lambda r: _let(blocks, lambda b: joined(r, b)))).otherwise(text)

    d = candidates.withColumn("text", _let(_decided(accepted, name), rewritten)).drop(name)
    return d.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in d.columns else d
