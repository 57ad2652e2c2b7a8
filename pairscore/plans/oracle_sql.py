"""SQL text fragments for the DuckDB oracle.

These mirror the Column functions in ``pairscore.functions`` one for one, so
each catalogue query can state its reference result as plain SQL. They are
string templates only; nothing here parses or plans SQL.
"""

from __future__ import annotations

from ..functions.stopwords import sql_list

# Same classes as functions.text (RE2 syntax).
JAVA_WS = "[ \\t\\n\\x0B\\f\\r]"
PY_WS = ("\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
         "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}")


def tokenize(e: str) -> str:
    trimmed = f"regexp_replace(lower({e}), '{JAVA_WS}+$', '')"
    return (f"(CASE WHEN {e} IS NULL THEN NULL WHEN {e} = '' THEN [''] "
            f"WHEN {trimmed} = '' THEN []::VARCHAR[] "
            f"ELSE regexp_split_to_array({trimmed}, '{JAVA_WS}') END)")


def remove_stop_words(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: lower(t) NOT IN ({sql_list()}))"


def term_length(e: str) -> str:
    return f"CAST(len(regexp_extract_all({e}, '[^{PY_WS}]+')) AS INTEGER)"


def word_match(q: str, d: str) -> str:
    inner = "[contains(lower(y), lower(x))::INT + contains(lower(x), lower(y))::INT FOR y IN {d}]"
    body = (f"list_sum([coalesce(list_sum({inner.format(d=d)}), 0) FOR x IN {q}])")
    return (f"CAST(CASE WHEN {q} IS NULL OR {d} IS NULL THEN NULL "
            f"ELSE coalesce({body}, 0) END AS INTEGER)")


def joined(tokens: str) -> str:
    return f"array_to_string({tokens}, '|')"


def cosine(a: str, b: str) -> str:
    return (f"(CASE WHEN len({a}) = len({b}) THEN list_dot_product({a}, {b}) / "
            f"nullif(sqrt(list_dot_product({a}, {a}) * list_dot_product({b}, {b})), 0) END)")


def euclidean(a: str, b: str) -> str:
    # zero-pad the shorter list, as the Spark side does with zip_with + coalesce
    return (f"sqrt(list_sum([(coalesce({a}[i], 0) - coalesce({b}[i], 0)) ** 2 "
            f"FOR i IN range(1, greatest(len({a}), len({b})) + 1)]))")


def min_levenshtein(q: str, d: str) -> str:
    return f"list_min([list_min([levenshtein(x, y) FOR y IN {d}]) FOR x IN {q}])"


def inverse_levenshtein(q: str, d: str) -> str:
    term = f"coalesce(1.0 / (1 + list_min([levenshtein(x, y) FOR y IN {d}])), 0.0)"
    return f"coalesce(list_sum([{term} FOR x IN {q}]), 0.0)"


# ------------------------------------------------------------------- stemming
# Porter's 1980 rules as CASE expressions over a word column w. Written apart from the Spark form: every step takes
# the letters anew to consonants and vowels, and the rule tables are spelt out here.

_FORM = ("list_reduce(string_split({e}, ''), lambda a, c: concat(a, CASE WHEN c IN ('a', 'e', 'i', 'o', 'u') "
         "OR (c = 'y' AND ends_with(a, 'k')) THEN 'V' ELSE 'k' END), '')")


def _form(e: str) -> str:
    return f"(CASE WHEN {e} = '' THEN '' ELSE {_FORM.format(e=e)} END)"


def _less(n: int) -> str:
    return f"substr(w, 1, length(w) - {n})"


def _m(e: str) -> str:
    return f"len(regexp_extract_all({_form(e)}, 'Vk'))"


_DOUBLE = f"(regexp_matches({_form('w')}, 'k$') AND substr(w, -1, 1) = substr(w, -2, 1) AND length(w) > 1)"


def _cvc(e: str) -> str:
    return f"(regexp_matches({_form(e)}, 'kVk$') AND NOT regexp_matches({e}, '[wxy]$'))"


# Suffix and replacement, longest first within each step.
_RULES = (
    (("ational", "ate"), ("ization", "ize"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
     ("tional", "tion"), ("biliti", "ble"), ("entli", "ent"), ("ousli", "ous"), ("ation", "ate"), ("alism", "al"),
     ("aliti", "al"), ("iviti", "ive"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"),
     ("alli", "al"), ("ator", "ate"), ("eli", "e")),
    (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ness", ""), ("ful", "")))
_DROPS = ("ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ion", "ism", "ate", "iti", "ous", "ive",
          "ize", "al", "er", "ic", "ou")


def stems(vocabulary: str) -> str:
    """CTEs ending in ``stems`` (word, stem) for the relation ``vocabulary`` (word)."""
    steps = [
        f"""CASE WHEN w LIKE '%sses' OR w LIKE '%ies' THEN {_less(2)} WHEN w LIKE '%ss' THEN w
             WHEN w LIKE '%s' THEN {_less(1)} ELSE w END""",
        f"""CASE WHEN w LIKE '%eed' THEN CASE WHEN {_m(_less(3))} > 0 THEN {_less(1)} ELSE w END
             WHEN w LIKE '%ed' AND contains({_form(_less(2))}, 'V') THEN concat({_less(2)}, '+')
             WHEN w LIKE '%ing' AND contains({_form(_less(3))}, 'V') THEN concat({_less(3)}, '+') ELSE w END"""]
    bare = "rtrim(w, '+')"
    steps.append(f"""CASE WHEN w NOT LIKE '%+' THEN w WHEN regexp_matches(w, '(at|bl|iz)[+]$') THEN concat({bare}, 'e')
             WHEN {_DOUBLE.replace("(w", "(" + bare).replace("split(w", "split(" + bare)} AND NOT regexp_matches(w, '[lsz][+]$')
               THEN substr({bare}, 1, length({bare}) - 1)
             WHEN {_m(bare)} = 1 AND {_cvc(bare)} THEN concat({bare}, 'e') ELSE {bare} END""")
    steps.append(f"CASE WHEN w LIKE '%y' AND contains({_form(_less(1))}, 'V') THEN concat({_less(1)}, 'i') ELSE w END")
    for rules in _RULES:
        steps.append("CASE " + " ".join(
            f"WHEN w LIKE '%{s}' THEN CASE WHEN {_m(_less(len(s)))} > 0 THEN concat({_less(len(s))}, '{r}') ELSE w END"
            for s, r in rules) + " ELSE w END")
    steps.append("CASE " + " ".join(
        f"WHEN w LIKE '%{s}' THEN CASE WHEN {_m(_less(len(s)))} > 1"
        + (" AND regexp_matches(w, '[st]ion$')" if s == "ion" else "") + f" THEN {_less(len(s))} ELSE w END"
        for s in _DROPS) + " ELSE w END")
    steps.append(f"""CASE WHEN w LIKE '%e' AND ({_m(_less(1))} > 1 OR ({_m(_less(1))} = 1 AND NOT {_cvc(_less(1))}))
             THEN {_less(1)} ELSE w END""")
    steps.append(f"CASE WHEN {_m('w')} > 1 AND {_DOUBLE} AND w LIKE '%l' THEN {_less(1)} ELSE w END")
    out = [f"p0 AS (SELECT word, word AS w FROM {vocabulary} WHERE regexp_full_match(word, '[a-z]{{3,}}'))"]
    out += [f"p{i} AS MATERIALIZED (SELECT word, {step} AS w FROM p{i - 1})" for i, step in enumerate(steps, 1)]
    out.append(f"stems AS (SELECT v.word, coalesce(p.w, v.word) AS stem FROM {vocabulary} v "
               f"LEFT JOIN p{len(steps)} p ON p.word = v.word)")
    return ",\n".join(out)
