"""Personal data by weak supervision (operator 7).  Native expressions only.

1. *Candidates* are spans of broad patterns; those of the four base kinds
   (email, ip, card, phone) are always reported.
2. *Labelers* vote on every candidate: +1 personal, -1 not, 0 no opinion.
   They test the strict form, check digits and ranges of the span (regex),
   known domains, prefixes, lengths and names (gazetteer), and words and
   characters around it (context).  A candidate that lies inside a base span
   could not be added and has no vote.
3. *EM* over the counts of vote patterns of the whole table estimates how
   reliable each labeler is for each kind and side, and the posterior of each
   pattern.  A kind with few candidates leans on the estimate over all kinds,
   by ``KIND_PRIOR`` candidates' weight.
4. A *span classifier* (logistic, on the votes and the shape of the span) is
   trained on those posteriors and decides which further candidates to add.

Only the table of distinct (kind, votes, shape) patterns reaches the driver.
Every field has a few values, so its size is bounded by their product,
whatever the number of documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.llm import spans as S
from starflow.session import materialise

# The base kinds.  Possessive repeats and the "start of a run or
# end of the last match" guard keep long texts linear; the matches are those
# of the plain patterns.
EMAIL = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
IP_VALID = rf"^{_PART}(?:\.{_PART}){{3}}$"
BASE = ["email", "ip", "card", "phone"]

# Further candidates, wider than the base kinds.
EXTRA = {
    "local_phone": r"(?<![0-9+(])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "masked_email": (r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{2,64}(?:\x20?[(\[]at[)\]]\x20?[a-z0-9-]{2,63}"
                     r"(?:\x20?[(\[]dot[)\]]\x20?|\.|\x20dot\x20)|\x20at\x20[a-z0-9-]{2,63}\x20dot\x20)"
                     r"(?:com|org|net|edu|gov|io|de|fr|es)\b"),
    "id_number": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "person": r"(?<![\p{L}])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.?\x20\p{Lu}\p{Ll}+(?:\x20\p{Lu}\p{Ll}+){0,2}",
}
KINDS = BASE + list(EXTRA)

# Gazetteers and context words.
DOMAINS = r"(?i)\.(?:com|org|net|edu|gov|io|info|de|fr|es|co|uk|eu)$"
RESERVED = r"(?i)example\.|localhost|^0*(?:0|127|255)\."
CUES = (r"(?i)\b(?:tel|phone|call|mobile|fax|contact|e-?mail|mail|write|reach|address|card|visa|iban|account"
        r"|ssn|social|name|signed|dear|born|server|host|login)\b[^\n]{0,12}$")
COUNTER_CUES = r"(?i)\b(?:version|section|chapter|isbn|issn|order|invoice|page|figure|table|part|fig|no)\b[^\n]{0,6}$"
CONTEXT = 24
# Strict forms, by kind: +1 where the span has it, -1 where not.
STRICT = {
    "email": r"^[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*@[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?\.[A-Za-z]{2,}$",
    "ip": r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$",
    "card": r"^(?:[0-9]{16,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4})$",
    "phone": r"^\+[1-9][0-9]{0,2}[\x20.-]?(?:\([0-9]{1,4}\)[\x20.-]?)?[0-9]+(?:[\x20.-][0-9]+)*$",
    "local_phone": r"^\(?[2-9][0-9]{2}[^0-9]+[2-9]",
    "masked_email": r"(?i)^[^\x20(\[]*[a-z][^\x20(\[]*\x20?(?:\(at\)|\[at\]).*(?:\(dot\)|\[dot\]|\.)",
    "id_number": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "person": r"^[^\x20]+\x20[^\x20]+\x20[^\x20]+",
}
# Lengths of account numbers by country (ISO 13616).
ACCOUNT_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20,
    "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27,
    "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24,
    "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26}
# Common given names of the four languages.
GIVEN_NAMES = (
    "Alexander Alice Ana Andrea Andreas Anna Anne Antonio Barbara Bernd Carlos Carmen Catherine Charles Charlotte "
    "Christian Christine Claire Claudia Daniel David Diego Elena Elizabeth Emily Emma Eric Eva Fernando Francisco "
    "Frank Gabriel George Hans Helen Henri Isabel Jack James Jan Jane Javier Jean Jennifer Jessica Joan John Jorge "
    "Jose Juan Julia Julie Karin Karl Kevin Klaus Laura Linda Louis Lucas Lucia Luis Manuel Marc Marco Maria Marie "
    "Mark Martin Mary Matthew Michael Miguel Monika Nathalie Nicolas Olivia Pablo Patricia Paul Pedro Peter Petra "
    "Philippe Pierre Rafael Richard Robert Rosa Sabine Sarah Sebastian Sofia Sophie Stefan Stephen Susan Thomas "
    "Ursula Victor William Wolfgang").split()
LABELERS = ["strict", "check", "gazetteer", "cue", "counter_cue", "edge"]
SHAPES = ["digits", "length", "parts"]
SMOOTH = 1.0
KIND_PRIOR = 20.0
ROUNDS = 30
ADD_FROM = 0.9


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    n = F.length(digits)
    marks = F.split(digits, "")
    total = F.aggregate(F.transform(marks, lambda ch, i: F.when((n - i) % 2 == 0, F.ascii(ch) - 48).otherwise(
        F.lit(0)) * 2 - F.when(((n - i) % 2 == 0) & (F.ascii(ch) >= 53), 9).otherwise(0)
        + F.when((n - i) % 2 == 1, F.ascii(ch) - 48).otherwise(0)), F.lit(0), lambda a, b: a + b)
    return (n > 0) & (total % 10 == 0)


def account_check(account: Column) -> Column:
    """Whether an account number leaves 1 when divided by 97 (ISO 7064)."""
    plain = F.regexp_replace(account, r"\x20", "")
    marks = F.split(F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4)), "")
    return F.aggregate(marks, F.lit(0), lambda a, ch: F.when(ch == "", a).when(
        F.ascii(ch) < 65, (a * 10 + F.ascii(ch) - 48) % 97).otherwise((a * 100 + F.ascii(ch) - 55) % 97)) == 1


def base_spans(text: Column) -> dict[str, Column]:
    """The base kinds; failing matches are dropped and not retried."""
    def card(x):
        d = _digits(x["s"])
        return F.length(d).between(16, 19) & luhn(d)

    return {
        "email": S.matches(text, EMAIL),
        "ip": F.filter(S.matches(text, IP), lambda x: x["s"].rlike(IP_VALID)),
        "card": F.filter(S.matches(text, CARD), card),
        "phone": F.filter(S.matches(text, PHONE), lambda x: F.length(_digits(x["s"])).between(8, 15)),
    }


def _vote(yes: Column, no: Column | None = None) -> Column:
    v = F.when(yes, 1)
    return (v.when(no, -1) if no is not None else v).otherwise(0)


def _with_votes(text: Column, spans: Column, kind: str) -> Column:
    """Spans with the vote of each labeler and a coarse shape."""
    def one(x):
        s, digits = x["s"], _digits(x["s"])
        before = F.substring(text, F.greatest(x["start"] - CONTEXT + 1, F.lit(1)),
                             F.least(x["start"], F.lit(CONTEXT)))
        after = F.substring(text, x["end"] + 1, F.lit(1))
        n = F.length(digits)
        strict = (account_check(s) if kind == "account" else s.rlike(STRICT[kind]))
        check = {
            "card": _vote(luhn(digits), ~luhn(digits)), "ip": _vote(s.rlike(IP_VALID), ~s.rlike(IP_VALID)),
            "phone": _vote(n.between(10, 13), n < 8),
            # The same separator throughout, or the area code in brackets.
            "local_phone": _vote(s.rlike(r"^(?:\(.*-|[^()]{3}([\x20.-])[^()]{3}\1)"),
                                 s.rlike(r"^[0-9]{3}([\x20.-])[0-9]{3}(?!\1)")),
            # Numbers that were printed in advertisements.
            "id_number": _vote(F.lit(False), s.rlike("^(?:078-05-1120|219-09-9999)$")),
            "account": _vote(n >= 8, n < 6), "email": _vote(F.length(s) <= 254, F.length(s) > 254),
        }.get(kind, F.lit(0))
        lengths = "|".join(f"{c}.{{{m - 2}}}" for c, m in ACCOUNT_LENGTHS.items())
        registered = F.regexp_replace(s, r"\x20", "").rlike(f"^(?:{lengths})$")
        gazetteer = {
            "email": _vote(s.rlike(DOMAINS)), "masked_email": _vote(s.rlike(DOMAINS)),
            "phone": _vote(s.rlike(r"^\+(?:1|33|34|44|49)[^0-9]")), "card": _vote(digits.rlike("^(?:4|5[1-5]|3[47]|6)")),
            "ip": _vote(F.lit(False), s.rlike(RESERVED)), "account": _vote(registered, ~registered),
            "person": _vote(s.rlike(rf"\x20(?:{'|'.join(GIVEN_NAMES)})(?:\x20|$)")),
        }.get(kind, F.lit(0))
        votes = {
            "strict": _vote(strict, ~strict) if kind != "person" else _vote(strict), "check": check, "gazetteer": gazetteer,
            "cue": _vote(before.rlike(CUES)), "counter_cue": _vote(F.lit(False), before.rlike(COUNTER_CUES)),
            "edge": F.when(after.rlike(r"[\p{L}0-9_/=]"), -1).otherwise(
                _vote((x["start"] == 0) | before.rlike(r"[\s(<\"':,;]$"))),
        }
        shape = {"digits": F.least(F.floor(n / 4), F.lit(5)), "length": F.least(F.floor(F.length(s) / 8), F.lit(5)),
                 "parts": F.least(F.size(F.split(s, r"[\x20.-]")), F.lit(6))}
        return F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), x["end"].alias("end"),
                        F.lit(kind).alias("kind"), *[votes[v].cast("int").alias(v) for v in LABELERS],
                        *[shape[f].cast("int").alias(f) for f in SHAPES])

    return F.transform(spans, one)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, spans: all candidates with votes; the text is read once."""
    t = F.col("t")
    found = docs.select("doc_id", S.text_column().alias("t"))
    base = base_spans(t)
    spans = [_with_votes(t, base[k], k) for k in BASE]
    known = F.concat(*base.values())
    spans += [_with_votes(t, S.outside(S.matches(t, p), known), k) for k, p in EXTRA.items()]
    return found.select("doc_id", F.concat(*spans).alias("spans"))


def fit_reliabilities(patterns: list[dict], rounds: int = ROUNDS) -> tuple[list[float], dict]:
    """EM for a two-class model with independent labelers given the class.

    ``patterns``: dicts of votes with their count ``n`` and, possibly, their
    ``kind``.  Returns the posterior of each pattern and the vote
    distributions of both classes by (labeler, vote) over all kinds and by
    (kind, labeler, vote).  Starts from the majority of votes.
    """
    post = [1 / (1 + math.exp(-sum(p[v] for v in LABELERS))) for p in patterns]
    kinds = sorted({p["kind"] for p in patterns if "kind" in p})
    table: dict = {}

    def sums(rows):
        """Candidates of each class, and by labeler and vote."""
        by = {(v, vote): [0.0, 0.0] for v in LABELERS for vote in (-1, 0, 1)}
        mass = [0.0, 0.0]
        for p, q in rows:
            for side, n in enumerate((p["n"] * q, p["n"] * (1 - q))):
                mass[side] += n
                for v in LABELERS:
                    by[v, p[v]][side] += n
        return mass, by

    for _ in range(rounds):
        rows = list(zip(patterns, post, strict=True))
        mass, by = sums(rows)
        prior = {None: (mass[0] + SMOOTH) / (sum(mass) + 2 * SMOOTH)}
        for key, n in by.items():
            table[key] = tuple((n[c] + SMOOTH) / (mass[c] + 3 * SMOOTH) for c in (0, 1))
        for kind in kinds:
            mass, by = sums([(p, q) for p, q in rows if p.get("kind") == kind])
            prior[kind] = (mass[0] + KIND_PRIOR * prior[None]) / (sum(mass) + KIND_PRIOR)
            for key, n in by.items():
                table[kind, *key] = tuple((n[c] + KIND_PRIOR * table[key][c]) / (mass[c] + KIND_PRIOR) for c in (0, 1))
        post = []
        for p in patterns:
            kind = p.get("kind")
            odds = [table[(kind, v, p[v]) if kind else (v, p[v])] for v in LABELERS if p[v]]
            z = math.log(prior[kind] / (1 - prior[kind])) + sum(math.log(yes / no) for yes, no in odds)
            post.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
    return post, table


def _features(p: dict) -> dict:
    x = {"bias": 1.0, f"kind={p['kind']}": 1.0}
    x |= {f"{v}={p[v]}": 1.0 for v in LABELERS if p[v]}
    x |= {f"{p['kind']}.{f}={p[f]}": 1.0 for f in SHAPES}
    return x


def fit_classifier(patterns: list[dict], post: list[float], steps: int = 200, l2: float = 1e-3) -> dict:
    """Logistic regression on the posteriors, weighted by pattern counts."""
    xs, total = [_features(p) for p in patterns], sum(p["n"] for p in patterns)
    w: dict[str, float] = {}
    for _ in range(steps):
        grad = {k: l2 * v for k, v in w.items()}
        for x, p, q in zip(xs, patterns, post, strict=True):
            z = sum(w.get(k, 0.0) for k in x)
            e = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - q) * p["n"] / total
            for k in x:
                grad[k] = grad.get(k, 0.0) + e
        for k, g in grad.items():
            w[k] = w.get(k, 0.0) - 2.0 * g
    return w


def _logit(x: Column, w: dict) -> Column:
    """The classifier as an expression over a span."""
    z = F.lit(w.get("bias", 0.0))
    for k, v in sorted(w.items()):
        name, _, value = k.partition("=")
        if name == "kind":
            z = z + F.when(x["kind"] == value, v).otherwise(0.0)
        elif "." in name:
            kind, f = name.split(".")
            z = z + F.when((x["kind"] == kind) & (x[f] == int(value)), v).otherwise(0.0)
        elif value:
            z = z + F.when(x[name] == int(value), v).otherwise(0.0)
    return z


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def find(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts and digest of the
    base spans, and all spans with those that the classifier adds.

    A null text is empty; a text without personal data has zero counts, the
    digest of the empty string and no spans.  Repeated rows are searched one
    by one, a null doc_id is carried through, other columns are not read, an
    empty table gives an empty result and trains nothing.
    """
    found = materialise(candidates(docs), "pii-candidates")
    flat = found.select(F.explode("spans").alias("x")).select("x.*")
    counted = flat.groupBy("kind", *LABELERS, *SHAPES).agg(F.count(F.lit(1)).alias("n"))
    patterns = sorted((r.asDict() for r in counted.collect()),
                      key=lambda r: tuple(r[k] for k in ["kind", *LABELERS, *SHAPES]))
    weights = fit_classifier(patterns, fit_reliabilities(patterns)[0]) if patterns else {}
    cut = math.log(ADD_FROM / (1 - ADD_FROM))
    n_base = len(BASE)
    base = F.filter("spans", lambda x: x["rank"] < n_base)
    parted = found.select("doc_id", base.alias("base"), F.filter(
        "spans", lambda x: (x["rank"] >= n_base) & (_logit(x, weights) >= cut)).alias("added"))
    slim = lambda c: F.sort_array(F.transform(c, lambda x: F.struct(
        x["rank"].alias("rank"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    both = parted.select("doc_id", slim(F.col("base")).alias("base"),
                         slim(F.concat("base", S.outside(F.col("added"), F.col("base")))).alias("all"))
    return both.select(
        "doc_id", *[_count(k) for k in BASE],
        F.sha2(S.joined(F.col("base")), 256).alias("base_sha256"), S.joined(F.col("all")).alias("spans"))
