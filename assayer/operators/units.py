"""Validity of unit codes by their grammar, in higher-order functions.

A code is a term: components joined by ``.`` and ``/``, a leading ``/`` allowed.  A component
is a whole number, a term in parentheses, or a symbol with an optional exponent; each but the
number may carry an annotation in braces, and an annotation may stand alone.  A symbol is a
unit atom, or a prefix and an atom that takes prefixes.  Codes are case-sensitive.

A code is cut into tokens and the tokens are folded: the state says whether a component or an
operator must come next and how many parentheses are open.  Nested parentheses are beyond a
pattern but not beyond the fold.  It runs on distinct values, after they were counted.
"""

from __future__ import annotations

from assayer.functions.exprs import text

# ---- fixed values of the grammar -------------------------------------------------
PREFIXES = ["Y", "Z", "E", "P", "T", "G", "M", "k", "h", "da", "d", "c", "m", "u", "n", "p", "f", "a", "z", "y",
            "Ki", "Mi", "Gi", "Ti"]
# Atoms that take a prefix.
METRIC = ["m", "s", "g", "rad", "K", "C", "cd", "mol", "sr", "Hz", "N", "Pa", "J", "W", "A", "V", "F", "Ohm", "S",
          "Wb", "Cel", "T", "H", "lm", "lx", "Bq", "Gy", "Sv", "L", "l", "ar", "t", "bar", "u", "eV", "cal", "kat",
          "U", "[iU]", "[IU]", "eq", "osm", "dyn", "erg", "m[Hg]", "m[H2O]", "B", "bit", "By", "Bd", "mho", "Ci", "R"]
PLAIN = ["min", "h", "d", "wk", "mo", "a", "deg", "'", "''", "gon", "%", "[ppth]", "[ppm]", "[ppb]", "[pptr]", "[pi]",
         "10*", "10^", "[pH]", "[in_i]", "[ft_i]", "[yd_i]", "[mi_i]", "[lb_av]", "[oz_av]", "[gr]", "[degF]", "[drp]",
         "[arb'U]", "[CFU]", "[PFU]", "[hpf]", "[lpf]", "[APL'U]", "[GPL'U]", "[MPL'U]", "[ELU]", "[EU]", "[cup_us]",
         "[tbs_us]", "[tsp_us]", "[foz_us]", "[pt_us]", "[qt_us]", "[gal_us]", "[Btu]", "[kn_i]", "[psi]", "[beth'U]",
         "[todd'U]", "[knk'U]", "[mclg'U]", "[HPF]", "[LPF]"]
# ----------------------------------------------------------------------------------

#: An annotation, one of the operators and parentheses, or what stands between them.  What
#: a square bracket holds belongs to the symbol.
TOKEN = r"\{[^{}]*\}|[./()]|(?:\[[^\[\]{}]*\]|[^./(){}\[\]])+|."


def _list(items: list[str]) -> str:
    return "array(" + ", ".join(text(i) for i in items) + ")"


def symbol_valid(symbol: str) -> str:
    """SQL: whether ``symbol`` is an atom, or a prefix and an atom that takes one; with an
    exponent after it or not."""
    bare = f"if({symbol} in ('10*', '10^'), {symbol}, regexp_replace({symbol}, '(?<=[^0-9+-])[+-]?[0-9]+$', ''))"
    return (
        f"exists(array({bare}), b -> array_contains({_list(PLAIN)}, b) or array_contains({_list(METRIC)}, b)"
        f" or exists({_list(PREFIXES)}, p -> startswith(b, p) and array_contains({_list(METRIC)}, substr(b, length(p) + 1))))"
    )


def valid_code(unit: str) -> str:
    """SQL: whether ``unit`` (text) is a code of the grammar; NULL and empty texts are not."""
    tokens = f"regexp_extract_all({unit}, {text(TOKEN)}, 0)"
    kind = (
        "case when startswith(t, '{') and endswith(t, '}') then 'note' when t in ('.', '/') then 'join'"
        " when t = '(' then 'open' when t = ')' then 'close' when t rlike '^[0-9]+$' then 'number'"
        f" when {symbol_valid('t')} then 'symbol' else 'wrong' end"
    )
    kinds = f"transform({tokens}, t -> {kind}) "
    # after: what the last token was; start counts as a place where a component must come.
    step = (
        "named_struct("
        "'ok', s.ok and case k"
        " when 'symbol' then s.after in ('start', 'join', 'open')"
        " when 'number' then s.after in ('start', 'join', 'open')"
        " when 'open' then s.after in ('start', 'join', 'open')"
        " when 'note' then s.after in ('start', 'join', 'open', 'symbol', 'close')"
        # Only a division may lead a term.
        " when 'join' then s.after in ('symbol', 'number', 'close', 'note')"
        " when 'lead' then s.after in ('start', 'open')"
        " when 'close' then s.after in ('symbol', 'number', 'close', 'note') and s.depth > 0"
        " else false end,"
        "'after', if(k = 'lead', 'join', k),"
        "'depth', s.depth + case k when 'open' then 1 when 'close' then -1 else 0 end)"
    )
    led = (  # a slash at the head of a term is no join
        f"transform(array(struct({tokens} as t, {kinds} as k)), x -> transform(x.k, (k, i) ->"
        " if(k = 'join' and x.t[i] = '/' and (i = 0 or x.k[i - 1] = 'open'), 'lead', k)))[0]"
    )
    return (
        f"coalesce(length({unit}) > 0 and aggregate({led}, named_struct('ok', true, 'after', 'start', 'depth', 0),"
        f" (s, k) -> {step}, s -> s.ok and s.depth = 0 and s.after in ('symbol', 'number', 'close', 'note')), false)"
    )
