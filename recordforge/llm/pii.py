"""Personal data: candidate spans scored by gradient-boosted trees.

Native: DataFrame functions only, all inside the scan's own stage; no shuffle.

Two layers make spans. The base layer takes every match of four fixed patterns that passes its
check. The method's layer proposes more: high-recall patterns, which may overlap anything, give candidates
with features of format and context; boosted trees score them as ``CASE`` expressions, a
logistic calibration makes the scores probabilities, and a threshold by kind selects. Base spans
always stay; a candidate that overlaps one of them, or a better candidate, goes.

The trees are fitted on the driver from labelled lines that a seeded generator writes
(TRAIN_LINES of them); the lines pass through the same expressions as documents do.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, as matched. Their starts and repeats are written so that a search is linear and
#: needs no deep recursion: a match cannot begin inside a run that a match before it could have taken.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What the candidate generators propose.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:\x20?[(\[]at[)\]]\x20?|\x20at\x20|@)[A-Za-z0-9-]{1,63}+(?:(?:\x20?[(\[]dot[)\]]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{1,63}+){1,4}+",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){1,7}:?(?:[0-9A-Fa-f]{1,4}:){0,6}[0-9A-Fa-f]{1,4}",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20.-]?[0-9]{2,6}){2,4}+",
    "phone": r"(?<![0-9])[(0-9][0-9)](?:[\x20()./-]{0,2}[0-9]){5,14}+",
}
#: Words that speak for a kind when they stand shortly before a span.
CONTEXT = {
    "email": r"e-?mail|contact|write to|reach|mailto|correo|courriel",
    "ip": r"\bip\b|address|host|server|ping|ipv6|login from",
    "card": r"card|visa|mastercard|amex|credit|debit|tarjeta|carte|karte",
    "phone": r"tel|phone|call|mobile|fax|cell|whatsapp|telefon|llame|appel",
}
CHUNK = 256
#: A candidate has fewer characters than REACH (an address of six parts is the longest) and more than two, and candidates of one
#: kind lie apart: so many others at most can start before it, or after it, and overlap it.
REACH = 512
NEIGHBOURS = REACH // 3 * len(KINDS)
TRAIN_LINES = 1600
ROUNDS, DEPTH, RATE = 24, 2, 0.3
#: The least calibrated probability that selects a candidate.
SELECT = 0.9


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def add(acc: Column, d: Column) -> Column:
        v = d.cast("int") * (acc["i"] % 2 + 1)
        return F.struct((acc["i"] + 1).alias("i"), (acc["s"] + v - F.when(v > 9, 9).otherwise(0)).alias("s"))

    each = F.filter(F.split(F.reverse(digits), ""), lambda d: d != "")
    return F.aggregate(each, F.struct(F.lit(0).alias("i"), F.lit(0).alias("s")), add, lambda a: a["s"] % 10 == 0)


def _passes(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(m, r"\."), lambda p: (F.length(part(p)) < 3) | ((F.length(part(p)) == 3) & (part(p) <= "255")))
    if kind == "card":
        return F.when(n.between(16, 19), luhn(_digits(m))).otherwise(False)
    return n.between(8, 15) if kind == "phone" else F.lit(True)


def _prefilter(kind: str, text: Column, wide: bool = True) -> Column:
    """True wherever the base pattern of the kind, or the ``wide`` one, can match: a cheap test that spares other texts the search."""
    if kind == "email":
        return text.contains("@") | text.rlike(r"[(\[]at[)\]]|\x20at\x20") if wide else text.contains("@")
    return text.contains(":") | text.rlike("[0-9]") if kind == "ip" else text.rlike("[0-9]")


def matches(text: Column, pattern: str, when: Column) -> Column:
    """Non-overlapping matches from the left: array of (start, end, m, before, after), in code points.

    The pieces between matches give the places. Their running sums are taken by chunks, so a
    text with very many matches needs no quadratic time.
    """
    found = F.when(when, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    pieces = F.when(when, F.split(text, pattern, -1)).otherwise(F.array().cast("array<string>"))
    both = F.struct(found.alias("m"), pieces.alias("p"))

    def places(b: Column) -> Column:
        n = F.size(b["m"])
        chunks = F.sequence(F.lit(0), F.floor((n - 1) / CHUNK).cast("int"))
        width = lambda i: F.char_length(F.get(b["p"], i)) + F.char_length(F.get(b["m"], i))
        inside = lambda j: F.sequence(j * CHUNK, F.least(n, (j + 1) * CHUNK) - 1)
        total = lambda j: F.aggregate(inside(j), F.lit(0), lambda a, i: a + width(i))
        bases = F.aggregate(chunks, F.array(F.lit(0)), lambda a, j: F.array_append(a, F.element_at(a, -1) + total(j)))

        def spread(j: Column, base: Column) -> Column:
            def step(acc: Column, i: Column) -> Column:
                start = acc["at"] + F.char_length(F.get(b["p"], i))
                end = start + F.char_length(F.get(b["m"], i))
                one = F.struct(
                    start.alias("start"),
                    end.alias("end"),
                    F.get(b["m"], i).alias("m"),
                    F.lower(F.right(F.get(b["p"], i), F.lit(24))).alias("before"),
                    F.left(F.get(b["p"], i + 1), F.lit(2)).alias("after"),
                )
                return F.struct(end.alias("at"), F.array_append(acc["out"], one).alias("out"))

            zero = F.struct(base.alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
            return F.aggregate(inside(j), zero, step, lambda a: a["out"])

        laid = F.flatten(F.zip_with(chunks, F.slice(bases, F.lit(1), F.size(chunks)), spread))
        return F.when(n > 0, laid).otherwise(F.array().cast(f"array<{SPAN}>"))

    return F.element_at(F.transform(F.array(both), places), 1)


SPAN = "struct<start:int,end:int,m:string,before:string,after:string>"


def _features(kind: str, c: Column) -> Column:
    m = c["m"]
    digits = _digits(m)
    yes = lambda x: F.when(x, 1.0).otherwise(0.0)
    groups = F.filter(F.split(m, "[^0-9A-Za-z]+"), lambda g: g != "")
    values = [
        F.length(digits).cast("double"),
        F.char_length(m).cast("double"),
        F.length(F.regexp_replace(m, "[0-9A-Za-z]", "")).cast("double"),
        F.size(groups).cast("double"),
        F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)).cast("double"),
        yes(c["before"].rlike(rf"(?:{CONTEXT[kind]})[^0-9a-z]{{0,6}}(?:[a-z]{{1,5}}[^0-9a-z]{{1,3}})?$")),
        yes(c["before"].rlike(r"[\p{L}\p{N}_/.,:=#$€-]$")),
        yes(c["after"].rlike(r"^[\p{L}\p{N}_/:%]|^[.,-][0-9]")),
        yes(m.rlike(r"^[12][0-9]{3}[-/.][01]?[0-9][-/.]|^[0-3]?[0-9][-/.][01]?[0-9][-/.][12][0-9]{3}|[0-9]:[0-5][0-9]")),
        yes(m.rlike(r"^\(?0?[0-9]{2,4}\)?[ ./-][0-9]{3,4}[ ./-][0-9]{3,5}$")),
        yes(m.rlike(r"^[0-9]{4}([ .-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}$")),
        F.when(F.length(digits).between(13, 19), yes(luhn(digits))).otherwise(0.0),
        yes(m.rlike(r"[(\[](?:at|dot)[)\]]")),
        yes(F.lower(m).rlike(r"(?:\.|dot[)\]]?\x20?)(?:com|org|net|edu|gov|io|de|fr|es|uk|eu|info)$")),
        yes(m.rlike(r"[a-fA-F]") & m.rlike("[0-9]")),
        yes(m.rlike(r"^[A-Za-z]+ at [A-Za-z]+ dot ")),
    ]
    return F.array(*values)


def candidates(kind: str, text: Column) -> Column:
    """Spans that the kind's generator proposes, with their features."""
    put = lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), _features(kind, c).alias("f"))
    return F.transform(matches(text, WIDE[kind], _prefilter(kind, text)), put)


def labelled_lines(seed: int = 6, n: int = TRAIN_LINES) -> list[tuple[str, str]]:
    """Lines with the kind of personal data in each, or none: what the trees are fitted on."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[rng.integers(len(xs))]
    num = lambda k: "".join(str(rng.integers(10)) for _ in range(k))
    word = lambda: "".join(pick("abcdefghijklmnoprstuvw") for _ in range(rng.integers(3, 9)))
    hexa = lambda: "".join(pick("0123456789abcdef") for _ in range(rng.integers(1, 5)))

    def card(ok: bool) -> str:
        body = num(15)
        s = sum((2 * int(d) - 9 * (int(d) > 4)) if i % 2 == 0 else int(d) for i, d in enumerate(body))
        end = (-s) % 10
        body += str(end if ok else (end + rng.integers(1, 10)) % 10)
        sep = pick(["", " ", "-", "."])
        return sep.join(body[i : i + 4] for i in range(0, 16, 4))

    def phone() -> str:
        s = pick([" ", "-", ".", "/"])
        return pick([f"0{num(2)}{s}{num(3)}{s}{num(4)}", f"({num(3)}) {num(3)}{s}{num(4)}", f"{num(3)}{s}{num(3)}{s}{num(4)}", f"0{num(3)}{s}{num(7)}", f"0{num(9)}"])

    yes = {
        "email": lambda: pick([f"{word()}{{a}}{word()}{{d}}{pick(['com', 'org', 'net', 'de', 'fr'])}"]).format(a=pick([" (at) ", "[at]", " at ", "(at)"]), d=pick([" (dot) ", "[dot]", " dot ", "."])),
        "ip": lambda: ":".join(hexa() for _ in range(8)) if rng.random() < 0.6 else ":".join(hexa() for _ in range(rng.integers(2, 5))) + "::" + hexa(),
        "card": lambda: card(rng.random() < 0.7),
        "phone": phone,
    }
    leads = {"email": ["email", "contact", "write to"], "ip": ["ip", "host", "server address"], "card": ["card", "visa", "credit card number"], "phone": ["tel", "phone", "call me:", "fax"]}
    no = [
        lambda: f"{rng.integers(1900, 2100)}-{num(1)}{num(1)}-{num(2)}",
        lambda: f"{num(2)}.{num(2)}.20{num(2)}",
        lambda: f"{rng.integers(24)}:{rng.integers(10, 60)}:{rng.integers(10, 60)}",
        lambda: num(int(rng.integers(5, 20))),
        lambda: card(False),
        lambda: f"v{num(1)}.{num(2)}.{num(3)}",
        lambda: f"978-{num(1)}-{num(2)}-{num(6)}-{num(1)}",
        lambda: f"{num(3)},{num(3)}.{num(2)}",
        lambda: f"{num(2)} {num(3)} {num(2)} {num(4)} {num(2)} {num(5)}",
        lambda: f"meet at {word()}. {word()}",
        lambda: f"{word()} at {word()}.{word()}",
        lambda: f"looked at {word()} dot {word()}",
        lambda: f"{word()}: {word()}:{word()}",
        lambda: f"{num(3)} {num(4)} {num(4)} {num(3)}",
        lambda: f"{num(4)}-{num(4)}",
    ]
    out = []
    for _ in range(n):
        if rng.random() < 0.45:
            kind = pick(KINDS)
            value = yes[kind]()
            bare = kind == "ip" or "(at)" in value or "[at]" in value
            lead = "" if bare and rng.random() < 0.4 else pick(leads[kind]) + pick([": ", " ", " is "])
            out.append((kind, f"{word()} {lead}{value}{pick([' ', '.', ', '])}{word()}"))
        else:
            lead = pick(["", "", "", "no. ", "order ", "the ", "ref: ", "id="])
            out.append(("none", f"{word()} {lead}{pick(no)()}{pick([' ', '.', ', '])}{word()}"))
    return out


class Boosted:
    """Gradient boosting of small regression trees on the logistic loss, calibrated on rows held out."""

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        fit = np.arange(len(y)) % 3 > 0
        self.base, self.trees = float(np.log((y[fit].sum() + 1) / (len(y[fit]) - y[fit].sum() + 1))), []
        score = np.full(len(y), self.base)
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(x[fit], (y - p)[fit], (p * (1 - p))[fit], DEPTH)
            self.trees.append(tree)
            score += self._of(tree, x)
        held = ~fit if (~fit).any() and 0 < y[~fit].sum() < (~fit).sum() else fit
        a, b = 1.0, 0.0
        for _ in range(50):  # Newton steps of a logistic fit with a weak prior at the identity
            p = 1 / (1 + np.exp(-(a * score[held] + b)))
            g = np.array([((p - y[held]) * score[held]).sum() + (a - 1), (p - y[held]).sum() + b])
            w = p * (1 - p)
            h = np.array([[(w * score[held] ** 2).sum() + 1, (w * score[held]).sum()], [(w * score[held]).sum(), w.sum() + 1]])
            a, b = np.array([a, b]) - np.linalg.solve(h, g)
        self.a, self.b = float(a), float(b)

    def _grow(self, x, g, h, depth):
        best = None
        total = g.sum() ** 2 / (h.sum() + 1)
        for j in range(x.shape[1] if depth else 0):
            for cut in np.unique(x[:, j])[:-1]:
                left = x[:, j] <= cut
                gain = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (left, ~left)) - total
                if gain > 1e-6 and (best is None or gain > best[0] + 1e-12):
                    best = (gain, j, float(cut), left)
        if best is None:
            return float(RATE * g.sum() / (h.sum() + 1))
        _, j, cut, left = best
        return (j, cut, self._grow(x[left], g[left], h[left], depth - 1), self._grow(x[~left], g[~left], h[~left], depth - 1))

    def _of(self, tree, x):
        if isinstance(tree, float):
            return np.full(len(x), tree)
        j, cut, left, right = tree
        return np.where(x[:, j] <= cut, self._of(left, x), self._of(right, x))

    def predict(self, x: np.ndarray) -> np.ndarray:
        score = self.base + sum(self._of(t, x) for t in self.trees)
        return 1 / (1 + np.exp(-(self.a * score + self.b)))

    def column(self, f: Column) -> Column:
        """The calibrated probability as a native expression of a feature array."""

        def of(tree) -> Column:
            if isinstance(tree, float):
                return F.lit(tree)
            j, cut, left, right = tree
            return F.when(F.get(f, F.lit(j)) <= cut, of(left)).otherwise(of(right))

        score = functools.reduce(lambda a, t: a + of(t), self.trees, F.lit(self.base))
        return 1 / (1 + F.exp(-(score * self.a + self.b)))


_fitted: dict[str, Boosted] = {}


def models(spark: SparkSession) -> dict[str, Boosted]:
    """The trees by kind, fitted once a process; the same lines give the same trees."""
    if not _fitted:
        lines = spark.createDataFrame(labelled_lines(), "label string, text string").coalesce(1)
        for kind in KINDS:
            rows = lines.select("label", F.explode(candidates(kind, F.col("text"))).alias("c")).select("label", "c.f").collect()
            x, y = np.array([r.f for r in rows]), np.array([float(r.label == kind) for r in rows])
            _fitted[kind] = Boosted(x, y)
    return _fitted


def _running_max(values: Column, least: int) -> Column:
    """For each place of an array of ints the greatest value before it (``least`` at first), by chunks, so in linear time."""

    def of(x: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / CHUNK).cast("int"))
        part = lambda j: F.slice(x, j * CHUNK + 1, F.lit(CHUNK))
        grow = lambda acc, v: F.array_append(acc, F.greatest(F.element_at(acc, -1), v))
        carry = F.aggregate(chunks, F.array(F.lit(least)), lambda acc, j: grow(acc, F.array_max(part(j))))
        spread = lambda j, c: F.slice(F.aggregate(part(j), F.array(c), grow), F.lit(1), F.size(part(j)))
        return F.flatten(F.zip_with(chunks, F.slice(carry, F.lit(1), F.size(chunks)), spread))

    return F.element_at(F.transform(F.array(values), of), 1)


def _apart(base: Column, more: Column) -> Column:
    """The candidates ``more`` that overlap no span of ``base``: one sweep over both in the order of their starts."""
    spot = lambda c, tag: F.struct(c["start"].alias("start"), F.lit(tag).alias("tag"), c["end"].alias("end"), c["p"].alias("p"), c["kind"].alias("kind"))
    put = lambda c: F.struct(c["start"].alias("start"), F.lit(0).alias("tag"), c["end"].alias("end"), F.lit(0.0).alias("p"), F.lit("").alias("kind"))
    both = F.array_sort(F.concat(F.transform(base, put), F.transform(more, lambda c: spot(c, 1))))

    def sweep(u: Column) -> Column:
        ended = _running_max(F.transform(u, lambda c: F.when(c["tag"] == 0, c["end"]).otherwise(-1)), -1)
        far = 1 << 30
        begins = F.reverse(_running_max(F.reverse(F.transform(u, lambda c: F.when(c["tag"] == 0, -c["start"]).otherwise(-far))), -far))
        met = F.arrays_zip(u.alias("u"), ended.alias("ended"), begins.alias("begins"))
        free = F.filter(met, lambda c: (c["u"]["tag"] == 1) & (c["ended"] <= c["u"]["start"]) & (-c["begins"] >= c["u"]["end"]))
        return F.transform(free, lambda c: c["u"])

    return F.element_at(F.transform(F.array(both), sweep), 1)


def _best(spots: Column) -> Column:
    """Of candidates in the order of their starts those that overlap no better one.

    A candidate has at most REACH characters and candidates of a kind do not overlap, so only so many
    neighbours in the order can meet it; those of a chunk are looked up in one slice around it.
    """
    over = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
    first = lambda a, b: (a["p"] > b["p"]) | ((a["p"] == b["p"]) & ((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["kind"] < b["kind"]))))

    def of(u: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.floor((F.size(u) - 1) / CHUNK).cast("int"))

        def keep(j: Column) -> Column:
            lo = F.greatest(F.lit(0), j * CHUNK - NEIGHBOURS)
            around = F.slice(u, lo + 1, F.lit(CHUNK + 2 * NEIGHBOURS))
            return F.filter(F.slice(u, j * CHUNK + 1, F.lit(CHUNK)), lambda c: ~F.exists(around, lambda d: over(c, d) & first(d, c)))

        return F.flatten(F.transform(chunks, keep))

    return F.element_at(F.transform(F.array(spots), of), 1)


def spans(docs: DataFrame, select: float = SELECT) -> DataFrame:
    """``docs`` with four columns more: ``base`` and ``found``, arrays of (kind, start, end) in code points, ``proposed``, ``likeliest``.

    base: matches of the base patterns that pass their check, by kind (email, ip, card, phone) and start.
    found: those and the candidates that the trees select, in the same order; a candidate that overlaps a base
    span or a better selected candidate goes. proposed counts the candidates, likeliest is their greatest probability
    (null without any). Places count code points, the end is exclusive. A null or empty text has
    none; texts are searched whole. Repeated rows are each searched; an empty table gives no rows. Columns that
    ``docs`` has under one of the four names are replaced, all others are kept.
    """
    trees = models(docs.sparkSession)
    text = F.coalesce("_text", F.lit(""))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    short = lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"))
    # the caller's row is one column, so that no name of its meets one made here
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text").alias("_text"))

    def based(k: str) -> Column:
        return F.transform(F.filter(matches(text, BASE[k], _prefilter(k, text, wide=False)), lambda c: _passes(k, c["m"])), short)

    def scored(k: str) -> Column:
        return F.transform(f"_wide_{k}", lambda c: F.struct(trees[k].column(c["f"]).alias("p"), c["start"].alias("start"), c["end"].alias("end"), F.lit(k).alias("kind")))

    for k in KINDS:
        out = out.withColumn(f"_base_{k}", based(k)).withColumn(f"_wide_{k}", candidates(k, text))
    whole = "array<struct<p:double,start:int,end:int,kind:string>>"
    for k in KINDS:
        out = out.withColumn(f"_wide_{k}", F.when(F.size(f"_wide_{k}") > 0, scored(k)).otherwise(F.array().cast(whole)))
    out = out.withColumn("_all", F.concat(*[F.col(f"_base_{k}") for k in KINDS]))
    out = out.withColumn("_wide", F.concat(*[F.col(f"_wide_{k}") for k in KINDS]))
    out = out.withColumn("_more", F.filter("_wide", lambda c: c["p"] >= select))
    spots = "array<struct<start:int,tag:int,end:int,p:double,kind:string>>"
    out = out.withColumn("_more", F.when(F.size("_more") > 0, _apart(F.col("_all"), F.col("_more"))).otherwise(F.array().cast(spots)))
    out = out.withColumn("_more", F.when(F.size("_more") > 1, _best(F.col("_more"))).otherwise(F.col("_more")))

    def of_kind(k: str, more: bool) -> Column:
        part = F.col(f"_base_{k}")
        if more:
            mine = F.transform(F.filter("_more", lambda c: c["kind"] == k), short)
            part = F.array_sort(F.concat(part, F.coalesce(mine, empty)))
        return F.transform(part, lambda c: F.struct(F.lit(k).alias("kind"), c["start"].alias("start"), c["end"].alias("end")))

    def by_kind(more: bool) -> Column:
        return F.concat(*[of_kind(k, more) for k in KINDS])

    made = {"base": by_kind(False), "found": by_kind(True), "proposed": F.size("_wide").cast("long"), "likeliest": F.array_max(F.transform("_wide", lambda c: c["p"]))}
    return out.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c.lower() not in made], *[v.alias(k) for k, v in made.items()])


def redact(docs: DataFrame, select: float = SELECT) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind, as ``[EMAIL]``; null texts stay null.

    Overlapping spans become the mark of the first. Other columns are kept as they are, whatever their names; repeated
    rows are each redacted; an empty table stays empty.
    """
    row = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_caller"))
    text = F.col("text")
    marked = spans(row, select).withColumn("found", F.array_sort(F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))))
    cut = lambda a, b: F.substring(text, a + 1, b - a)

    def step(acc: Column, s: Column) -> Column:
        more = F.when(s["start"] >= acc["at"], F.concat(acc["out"], cut(acc["at"], s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), more.otherwise(acc["out"]).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    new = F.aggregate("found", zero, step, lambda a: F.concat(a["out"], cut(a["at"], F.char_length(text))))
    marked = marked.select("_caller", F.when(F.size("found") > 0, new).otherwise(text).alias("_new"))
    return marked.select(*[F.col("_new").alias(c) if c.lower() == "text" else F.col("_caller")[c].alias(c) for c in docs.columns])


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents; counts and digest of the base spans, all spans, and what the trees were asked.

    n_candidates and likeliest: the spans that the generators propose and the greatest probability that the trees
    give one; n_added: the spans that they add to those of the base patterns.
    """
    out = spans(common.table(spark, sf_dir, "documents", "doc_id", "text"))

    def count(k: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")

    counts = [count(k) for k in KINDS]
    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    added = (F.size("found") - F.size("base")).cast("long").alias("n_added")
    digest = F.sha2(line("base").cast("binary"), 256).alias("base_sha256")
    return out.select("doc_id", *counts, digest, line("found").alias("spans"), F.col("proposed").alias("n_candidates"), added, F.round("likeliest", 6).alias("likeliest"))
