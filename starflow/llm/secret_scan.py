"""Secret scan with sliding-window entropy (operator 3).  Native expressions only.

Three exact kinds (assign, access, hex) are matched by pattern.  The method
adds candidates: long unbroken strings over one character class.  A window of
fixed width slides over a candidate; the counts of its characters change by
one entering and one leaving character, and with them the sum of
``c * log2(c)`` from which the Shannon entropy of the window follows.  Each
stretch that windows over the class's threshold cover is reported, unless a
base span covers it.

The allow-list takes away what it names and no more: filler is cut out of a
candidate and the pieces around it are scanned on their own, so a key with a
run of equal letters in it is still found; a placeholder's word clears a
stretch of at most PLACEHOLDER_LENGTH characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starflow.llm import spans as S

# The base kinds.
ASSIGN = (r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
          r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

WINDOW = 20
# Per class: candidate strings (whole runs of the class), its characters, and
# the entropy in bits from which a window counts.
CLASSES = {
    "hex_entropy": (r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{20,}", "0123456789ABCDEFabcdef", 3.0),
    "base64_entropy": (r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.75),
}
# The allow-list: parts that are no secret however mixed they look, and words
# of strings that stand for a secret.
FILLER = r"(?i:0123456789|1234567890|abcdefghij|qwertyuiop)|([A-Za-z0-9+/_=-])\1{5,}"
PLACEHOLDER = r"(?i)example|sample|placeholder|changeme|dummy|your[_-]?(?:key|token|secret)"
PLACEHOLDER_LENGTH = 64


def _xlogx(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))


def hot_stretches(s: Column, alphabet: str, threshold: float, width: int = WINDOW) -> Column:
    """array of struct(start, end) within ``s``: the stretches covered by
    windows of entropy ``threshold`` or more; windows that overlap or touch
    make one stretch."""
    codes = F.transform(F.split(s, ""), lambda ch: F.instr(F.lit(alphabet), ch) - 1)
    steps = F.transform(codes, lambda c, i: F.struct(
        c.alias("enter"), F.when(i >= width, F.get(codes, i - width)).otherwise(F.lit(-1)).alias("leave"),
        i.alias("i")))
    start = F.struct(F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0.0).alias("sum"),
                     F.array().cast("array<struct<start:int,end:int>>").alias("done"),
                     F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"))

    def step(acc, x):
        before_in = F.get(acc["counts"], x["enter"])
        same = x["enter"] == x["leave"]
        gone = x["leave"] >= 0
        before_out = F.coalesce(F.get(acc["counts"], F.greatest(x["leave"], F.lit(0))), F.lit(0))
        total = F.when(same, acc["sum"]).otherwise(
            acc["sum"] + _xlogx(before_in + 1) - _xlogx(before_in)
            + F.when(gone, _xlogx(before_out - 1) - _xlogx(before_out)).otherwise(F.lit(0.0)))
        counts = F.when(same, acc["counts"]).otherwise(F.transform(
            acc["counts"], lambda c, k: c + (k == x["enter"]).cast("int") - (k == x["leave"]).cast("int")))
        entropy = F.lit(width).cast("double")
        entropy = F.log2(entropy) - total / entropy
        hot = (x["i"] >= width - 1) & (entropy >= threshold)
        # A window that starts behind the stretch so far begins another one.
        first = x["i"] - (width - 1)
        apart = hot & (first > acc["end"])
        return F.struct(
            counts.alias("counts"), total.alias("sum"),
            F.when(apart, F.concat(acc["done"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end")))))
            .otherwise(acc["done"]).alias("done"),
            F.when(hot & (apart | acc["start"].isNull()), first).otherwise(acc["start"]).alias("start"),
            F.when(hot, x["i"] + 1).otherwise(acc["end"]).alias("end"))

    def finish(acc):
        last = F.struct(acc["start"].alias("start"), acc["end"].alias("end"))
        return F.when(acc["start"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(last)))

    return F.aggregate(steps, start, step, finish)


def _mixed(s: Column) -> Column:
    return s.rlike("[0-9]") & s.rlike("[A-Za-z]")


def entropy_spans(text: Column, pattern: str, alphabet: str, threshold: float) -> Column:
    """Spans of high entropy in the candidate strings of one class, with both
    a letter and a digit and outside the allow-list."""
    candidates = F.filter(S.matches(text, pattern), lambda x: _mixed(x["s"]))
    pieces = F.flatten(F.transform(candidates, lambda x: F.transform(S.between(x["s"], FILLER), lambda p: F.struct(
        (x["start"] + p["start"]).alias("start"), p["s"].alias("s")))))
    pieces = F.filter(pieces, lambda p: (F.length(p["s"]) >= WINDOW) & _mixed(p["s"]))
    spans = F.flatten(F.transform(pieces, lambda p: F.transform(
        hot_stretches(p["s"], alphabet, threshold), lambda h: F.struct(
            (p["start"] + h["start"]).alias("start"), (p["start"] + h["end"]).alias("end"),
            F.substring(p["s"], h["start"] + 1, h["end"] - h["start"]).alias("s")))))
    return F.filter(spans, lambda x: _mixed(x["s"]) & ~(
        (F.length(x["s"]) <= PLACEHOLDER_LENGTH) & x["s"].rlike(PLACEHOLDER)))


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts and digest of the
    base spans, and all spans with what the entropy windows add.

    A null text is empty; a text without secrets has zero counts, the digest
    of the empty string and no spans.  Repeated rows are scanned one by one,
    a null doc_id is carried through, other columns are not read, an empty
    table gives an empty result.
    """
    t = F.col("t")
    whole = S.matches(t, ASSIGN)
    values = F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(1))
    long_enough = F.filter(F.transform(whole, lambda x, i: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["s"].alias("s"),
        F.length(F.get(values, i)).alias("n"))), lambda x: x["n"] >= ASSIGN_VALUE)
    found = docs.select("doc_id", S.text_column().alias("t")).select(
        "doc_id",
        S.labelled(long_enough, "assign", 0).alias("assign"),
        S.labelled(S.matches(t, ACCESS), "access", 1).alias("access"),
        S.labelled(S.matches(t, HEX), "hex", 2).alias("hex"),
        F.concat(*[S.labelled(entropy_spans(t, *c), k, 3 + i)
                   for i, (k, c) in enumerate(CLASSES.items())]).alias("added"))
    base = found.withColumn("base", F.sort_array(F.concat("assign", "access", "hex")))
    both = base.withColumn("all", F.sort_array(F.concat("base", S.outside(F.col("added"), F.col("base")))))
    return both.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(S.joined(F.col("base")), 256).alias("base_sha256"), S.joined(F.col("all")).alias("spans"))
