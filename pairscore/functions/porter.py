"""Porter's suffix-stripping stemmer (M. F. Porter, "An algorithm for suffix
stripping", Program 14(3), 1980), for lowercase words.

``stem_words`` is the form for a table of words, built-in expressions only;
``stem`` is the same for one Python string, for tasks that hold whole texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VOWELS = frozenset("aeiou")
_FORMS = {ord(c): "v" if c in _VOWELS else "c" for c in "abcdefghijklmnopqrstuvwxz"}


def _form_of(w: str) -> str:
    """A word's form, one letter for each of ``w``: c for a consonant, v for a vowel; y is a vowel after a consonant."""
    if "y" not in w:
        return w.translate(_FORMS)
    form, last = [], "v"
    for c in w:
        last = "v" if c in _VOWELS or (c == "y" and last == "c") else "c"
        form.append(last)
    return "".join(form)


def _measure(stem: str) -> int:
    """m in [C](VC){m}[V]: the number of vowel-consonant runs."""
    return _form_of(stem).count("vc")


def _has_vowel(stem: str) -> bool:
    return "v" in _form_of(stem)


def _double_consonant(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _form_of(w)[-1] == "c"


def _cvc(w: str) -> bool:
    """Ends consonant-vowel-consonant, the last not w, x or y."""
    return w[-1:] not in ("w", "x", "y") and _form_of(w).endswith("cvc")


# The suffix rules of steps 2, 3 and 4 as published (1980).
STEP2 = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
         ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
         ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
         ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
         ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"))
STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
         ("ful", ""), ("ness", ""))
STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
         "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")
_SUFFIXES = {rules: tuple(r[0] if isinstance(r, tuple) else r for r in rules) for rules in (STEP2, STEP3, STEP4)}


def _longest(word: str, suffixes):
    if not word.endswith(_SUFFIXES[suffixes]):
        return None
    best = None
    for s in suffixes:
        key = s[0] if isinstance(s, tuple) else s
        if word.endswith(key) and (best is None or len(key) > len(best[0])):
            best = s if isinstance(s, tuple) else (s, "")
    return best


def _step1(w: str) -> str:
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]

    if w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    else:
        stripped = None
        for suf in ("ed", "ing"):
            if w.endswith(suf) and _has_vowel(w[:-len(suf)]):
                stripped = w[:-len(suf)]
                break
        if stripped is not None:
            w = stripped
            if w.endswith(("at", "bl", "iz")):
                w += "e"
            elif _double_consonant(w) and w[-1] not in "lsz":
                w = w[:-1]
            elif _measure(w) == 1 and _cvc(w):
                w += "e"

    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    return w


def _replace(w: str, rules) -> str:
    """Steps 2 and 3: the longest matching suffix is replaced when m > 0."""
    hit = _longest(w, rules)
    if hit is None:
        return w
    suf, rep = hit
    stem = w[:-len(suf)]
    return stem + rep if _measure(stem) > 0 else w


def _step4(w: str) -> str:
    hit = _longest(w, STEP4)
    if hit is None:
        return w
    stem = w[:-len(hit[0])]
    if _measure(stem) <= 1:
        return w
    if hit[0] == "ion" and not stem.endswith(("s", "t")):
        return w
    return stem


def _step5(w: str) -> str:
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _cvc(w[:-1])):
            w = w[:-1]
    if _measure(w) > 1 and _double_consonant(w) and w.endswith("l"):
        w = w[:-1]
    return w


def stem(word: str | None) -> str | None:
    """Porter stem of a lowercase word; words of one or two letters and
    words with characters outside a-z are returned unchanged."""
    if word is None or len(word) <= 2 or not (word.isascii() and word.isalpha() and word.islower()):
        return word
    w = _step1(word)
    w = _replace(w, STEP2)
    w = _replace(w, STEP3)
    w = _step4(w)
    return _step5(w)


# ------------------------------------------------------------- Spark expressions
# A word is carried as (w, f): its letters and its form, a string of c (consonant) and v (vowel) of equal length.
# Whether y is a vowel depends on the letters before it only, so cutting a word cuts its form.

def _form(w):
    letter = lambda acc, ch: F.concat(acc, F.when(
        ch.isin(*sorted(_VOWELS)) | ((ch == "y") & F.endswith(acc, F.lit("c"))), "v").otherwise("c"))
    return F.aggregate(F.split(w, ""), F.lit(""), letter)


def _count(f):
    """m of a stem from its form."""
    return F.regexp_count(f, F.lit("vc"))


def _letters(add: str) -> str:
    """Form of letters that a rule adds; none of them is y."""
    return "".join("v" if c in _VOWELS else "c" for c in add)


class _Word:
    """The columns w and f of a vocabulary table, and the (w, f) that come of cutting and adding letters."""

    @property
    def w(self):
        return F.col("w")

    @property
    def f(self):
        return F.col("f")

    def head(self, n):
        """Form without the last n letters."""
        return F.left(self.f, F.length(self.f) - n)

    def cut(self, n, add=""):
        return F.struct(F.concat(F.left(self.w, F.length(self.w) - n), F.lit(add)).alias("w"),
                        F.concat(self.head(n), F.lit(_letters(add))).alias("f"))

    def same(self):
        return self.cut(0)

    def ends(self, *suffixes):
        out = F.lit(False)
        for s in suffixes:
            out = out | F.endswith(self.w, F.lit(s))
        return out

    def longest(self, rules):
        """(w, f, hit): the rule with the longest suffix of the word; hit is null where none fits. The rules are one
        literal array, which keeps the generated code small."""
        table = F.array(*[F.struct(F.lit(a).alias("suffix"), F.lit(b).alias("other"), F.lit(_letters(b)).alias("form"))
                          for a, b in sorted(rules, key=lambda r: -len(r[0]))])
        hit = F.get(F.filter(table, lambda r: F.endswith(F.col("w"), r["suffix"])), F.lit(0))
        return F.struct(self.w.alias("w"), self.f.alias("f"), hit.alias("hit"))

    def doubled(self):
        return (F.length(self.w) >= 2) & self.ends_form("c") & (F.right(self.w, F.lit(1)) == F.left(F.right(self.w, F.lit(2)), F.lit(1)))

    def ends_form(self, s):
        return F.endswith(self.f, F.lit(s))


def _steps():
    """The steps in order; each gives the next (w, f)."""
    x = _Word()
    yield (F.when(x.ends("sses", "ies"), x.cut(2)).when(x.ends("ss"), x.same()).when(x.ends("s"), x.cut(1))
           .otherwise(x.same()))
    stripped = [x.ends(s) & F.contains(x.head(len(s)), F.lit("v")) for s in ("ed", "ing")]
    mark = lambda to, on: to.withField("cut", F.lit(on))
    yield (F.when(x.ends("eed"), F.when(_count(x.head(3)) > 0, mark(x.cut(1), False)).otherwise(mark(x.same(), False)))
           .when(stripped[0], mark(x.cut(2), True)).when(stripped[1], mark(x.cut(3), True)).otherwise(mark(x.same(), False)))
    short = x.ends_form("cvc") & ~x.ends("w", "x", "y")
    yield (F.when(~F.col("cut"), x.same()).when(x.ends("at", "bl", "iz"), x.cut(0, "e"))
           .when(x.doubled() & ~x.ends("l", "s", "z"), x.cut(1)).when((_count(x.f) == 1) & short, x.cut(0, "e"))
           .otherwise(x.same()))
    yield F.when(x.ends("y") & F.contains(x.head(1), F.lit("v")), x.cut(1, "i")).otherwise(x.same())
    for rules, least in ((STEP2, 0), (STEP3, 0), ([(r, "") for r in STEP4], 1)):
        yield x.longest(rules)
        head = x.head(F.length("hit.suffix"))
        good = (_count(head) > least) & ((F.col("hit.suffix") != "ion") | x.ends("sion", "tion"))
        yield F.when(good, F.struct(
            F.concat(F.left(x.w, F.length(head)), "hit.other").alias("w"), F.concat(head, "hit.form").alias("f"))).otherwise(x.same())
    before = F.left(x.w, F.length(x.w) - 1)
    open_ = F.endswith(x.head(1), F.lit("cvc")) & ~F.right(before, F.lit(1)).isin("w", "x", "y")
    m = _count(x.head(1))
    yield F.when(x.ends("e") & ((m > 1) | ((m == 1) & ~open_)), x.cut(1)).otherwise(x.same())
    yield F.when((_count(x.f) > 1) & x.doubled() & x.ends("l"), x.cut(1)).otherwise(x.same())


def stem_words(words: DataFrame, col: str, out_col: str) -> DataFrame:
    """``words`` with the stem of ``col``; words of one or two letters and words with characters outside a-z stay as
    they are, NULL stays NULL. One projection a step, so no expression is evaluated twice."""
    keep = words.columns
    plain = F.regexp_like(F.col(col), F.lit("^[a-z]{3,}$"))
    out = words.withColumn("w", F.when(plain, F.col(col))).withColumn("f", _form(F.col("w")))
    for step in _steps():
        names = [*keep, "_s"]
        out = out.withColumn("_s", step).select(*names)
        out = out.select(*keep, "_s.*")
    return out.select(*keep, F.when(plain, F.col("w")).otherwise(F.col(col)).alias(out_col))
