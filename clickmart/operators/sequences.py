"""Ordered sequences as mergeable values.

A sequence of tokens is stood for by a polynomial hash: token t is the map x -> x*B + h(t) modulo a
prime, and a sequence is the composition of its tokens' maps, again such a map. Composition is
associative, so pieces of a sequence are hashed wherever they lie and joined in their order,
piece by piece, and how a sequence was cut into pieces doesn't show in the result. The same holds for
its text's length and its first ``HEAD`` characters.

A value is a struct: ``n`` tokens, ``chars`` of the text (tokens joined by the separator), ``head`` (the
text's beginning) and for each of four bases the map's factor ``p`` and summand ``h``. Texts of at most
``HEAD`` characters are known whole. Longer ones are taken as equal if their head, length
and all four hashes agree (about 124 bits).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRIME = 2**31 - 1  # products of two residues fit a long
#: Fixed bases of the four hashes, any numbers below the prime.
BASES = (1_103_515_245, 1_664_525, 69_069, 1_597_334_677)
HEAD = 256


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _maps(pairs: list[tuple[str, str]]) -> str:
    """Fields of the maps' factors and summands; expressions are SQL, which builds in one call."""
    return ", ".join(f"'p{i}', {p}, 'h{i}', {h}" for i, (p, h) in enumerate(pairs))


_EACH = range(len(BASES))
_ONE = _maps([("1L", "0L")] * len(BASES))


def _then(a: str, b: str) -> list[tuple[str, str]]:
    """The maps of ``a``'s tokens followed by ``b``'s."""
    return [(f"{a}.p{i} * {b}.p{i} % {PRIME}L", f"({a}.h{i} * {b}.p{i} + {b}.h{i}) % {PRIME}L") for i in _EACH]


def _value(n: str, chars: str, head: str, maps: str) -> str:
    return f"named_struct('n', {n}, 'chars', {chars}, 'head', {head}, {maps})"


def empty() -> str:
    """The sequence without tokens."""
    return _value("0L", "0L", "''", _ONE)


def _token_maps(text: str, separator: str) -> str:
    """Maps of a text, whose own separators count as cuts between tokens."""
    # a token's hashes depend on its base's number, so that one chance meeting isn't four
    token = "named_struct(" + _maps(
        [(f"{base}L", f"pmod(xxhash64(t, {i}), {PRIME}L)") for i, base in enumerate(BASES)]) + ")"
    tokens = f"transform(split({text}, {_quoted(chr(92) + 'Q' + separator + chr(92) + 'E')}, -1), t -> {token})"
    return f"aggregate({tokens}, named_struct({_ONE}), (a, b) -> named_struct({_maps(_then('a', 'b'))}))"


def _power(maps: str, times: str) -> str:
    """A map applied ``times`` times (at least once), by squaring."""
    done = ", ".join(
        f"'{kind}{i}', if(getbit({times}, bit) = 1, {new}, s.done.{kind}{i})"
        for i, pair in enumerate(_then("s.done", "s.square")) for kind, new in zip("ph", pair, strict=True))
    square = _maps(_then("s.square", "s.square"))
    return (f"aggregate(sequence(0, cast(floor(log2({times})) as int) + 1), "
            f"named_struct('done', named_struct({_ONE}), 'square', {maps}), "
            f"(s, bit) -> named_struct('done', named_struct({done}), 'square', named_struct({square})), s -> s.done)")


def run(text: str, times: str, separator: str, head: int = HEAD) -> str:
    """The sequence that holds ``text`` ``times`` times (SQL of a string and a long); a null text gives none."""
    gap = len(separator)
    shown = f"array_repeat({text}, cast(least({times}, {head // gap + 1}L) as int))"
    start = f"substring(array_join({shown}, {_quoted(separator)}), 1, {head})"
    # transforms of one-element arrays compute a map once, wherever it is mentioned
    maps = f"transform(array({_token_maps(text, separator)}), e -> if({times} = 1, e, {_power('e', times)}))"
    value = _value(times, f"{times} * (length({text}) + {gap}) - {gap}", start,
                   _maps([(f"m.p{i}", f"m.h{i}") for i in _EACH]))
    return f"if({text} is null, {empty()}, get(transform({maps}, m -> {value}), 0))"


def joined(values: str, separator: str, head: int = HEAD) -> str:
    """One value of an array of values in their order; one fold, whose state is a value."""
    # where the head is full, what follows adds nothing to it
    start = f"if(length(a.head) >= {head}, a.head, substring(concat(a.head, {_quoted(separator)}, b.head), 1, {head}))"
    both = _value("a.n + b.n", f"a.chars + b.chars + {len(separator)}", start, _maps(_then("a", "b")))
    return f"aggregate({values}, {empty()}, (a, b) -> case when b.n = 0 then a when a.n = 0 then b else {both} end)"


def same_as(value: str, head: int = HEAD) -> list[str]:
    """Grouping columns: equal for equal texts. A text known whole is its own key."""
    hashes = [f"if({value}.chars > {head}, {value}.h{i}, null) as __h{i}" for i in _EACH]
    return [f"{value}.head as head", f"if({value}.chars > {head}, {value}.chars, null) as __chars", *hashes]


def cascade(rows: DataFrame, key: str, moment: str, value: str, order: list[str], separator: str, head: int = HEAD,
            levels: tuple[str, ...] = ("SECOND", "HOUR")) -> DataFrame:
    """One value for each ``key`` of rows with a ``value`` at a ``moment``, joined level by level:
    moments to seconds, seconds to hours, hours to the whole. A task holds the moments of
    one second, the seconds of one hour or the hours of one key, however many rows a key has."""
    for level in (*levels, None):
        parts = f"transform(sort_array(collect_list(struct({', '.join([*order, value])}))), s -> s.{value})"
        by = [key, F.date_trunc(level, moment).alias(moment)] if level else [key]
        rows = rows.groupBy(*by).agg(F.expr(joined(parts, separator, head)).alias(value))
        order = [moment]
    return rows
