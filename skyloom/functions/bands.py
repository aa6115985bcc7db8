"""Per-pixel band mathematics: masks, ratios, synthesis, change scores and free expressions.

Values of a pixel are an `array<double>` in the order of its bands, unless a function takes
columns by name.  Zero means "no data".
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the hyperspectral bands that make up multispectral bands B02..B10
SYNTHESIS: dict[str, list[int]] = {
    "B02": list(range(11, 17)),
    "B03": list(range(9, 11)),
    "B04": list(range(18, 26)),
    "B05": list(range(28, 34)),
    "B06": list(range(42, 46)),
    "B07": list(range(49, 54)),
    "B08": list(range(106, 116)),
    "B09": list(range(141, 161)),
    "B10": list(range(193, 220)),
}

CO2_LINE, CO2_PEAK = (183, 184, 188, 189), (185, 186)
CO2_SHIFT = 0.1 / 80.0


def mask_positive(v: Column) -> Column:
    """All bands are above zero."""
    return F.forall(v, lambda x: x > 0)


def mask_truthy(v: Column) -> Column:
    """The first band is above zero and the rest are not zero."""
    return (v[0] > 0) & F.forall(F.slice(v, F.lit(2), F.greatest(F.size(v) - 1, F.lit(0))), lambda x: x != 0)


def opaque(v: Column) -> Column:
    """No band is zero."""
    return ~F.exists(v, lambda x: x == 0)


def subset(v: Column, bands: list[str], names: list[str]) -> Column:
    """The named bands' values, in the order asked for."""
    return F.array(*(v[bands.index(n)] for n in names))


def ratios(v: Column) -> Column:
    """v[i] / v[j] for all i < j, i first."""
    n = F.size(v)
    rest = lambda i: F.filter(F.sequence(F.lit(0), n - 1), lambda j: j > i)
    return F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.transform(rest(i), lambda j: F.try_divide(F.get(v, i), F.get(v, j)))))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def gray(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def change_score(a: Column, b: Column) -> Column:
    """One less the squared cosine of two pixels' spectra; null if either is all zero."""
    xx, yy, xy = dot(a, a), dot(b, b), dot(a, b)
    return F.try_divide(xx * yy - xy * xy, xx * yy)


def unit_range(p: Column) -> Column:
    """Values outside 0..1 become 0."""
    return F.when((p < 0) | (p > 1), F.lit(0.0)).otherwise(p)


def noise_cut(v: Column, mask: Column, below: float = 0.01) -> Column:
    return F.when(mask < below, F.lit(0.0)).otherwise(v)


def co2_index(band: dict[int, Column]) -> Column:
    """How far the two peak bands lie under the line through four neighbours, in logarithms of
    radiance.  `band` maps numbers to columns; 0 if any of the six is missing."""
    if any(b not in band for b in (*CO2_LINE, *CO2_PEAK)):
        return F.lit(0.0)
    logs = {b: F.ln(band[b] + CO2_SHIFT) for b in (*CO2_LINE, *CO2_PEAK)}
    n, mean = len(CO2_LINE), sum(CO2_LINE) / len(CO2_LINE)
    sxx = sum((b - mean) ** 2 for b in CO2_LINE)
    level = sum((logs[b] for b in CO2_LINE), F.lit(0.0)) / n
    slope = sum((logs[b] * ((b - mean) / sxx) for b in CO2_LINE), F.lit(0.0))
    above = sum((logs[b] - (level + slope * (b - mean)) for b in CO2_PEAK), F.lit(0.0)) / len(CO2_PEAK)
    return F.exp(-above)


def co2_analytic(pixels: DataFrame, bands: list[str]) -> DataFrame:
    """Adds CO2 and drops the six bands that it is made of."""
    used = [f"B{b:03d}" for b in (*CO2_LINE, *CO2_PEAK)]
    index = co2_index({int(b[1:]): F.col(b) for b in bands if b in used})
    return pixels.withColumn("CO2", index).drop(*used)


def co2_bands(bands: list[str]) -> list[str]:
    used = {f"B{b:03d}" for b in (*CO2_LINE, *CO2_PEAK)}
    return [b for b in bands if b not in used] + ["CO2"]


def synthesise(v: Column, bands: list[int], groups: dict[str, list[int]] | None = None, weights: dict[str, list[float]] | None = None) -> dict[str, Column]:
    """Multispectral bands as weighted sums (means by default) of the members that are present.
    Groups without members are left out."""
    out = {}
    for name, members in (groups or SYNTHESIS).items():
        here = [b for b in members if b in bands]
        if not here:
            continue
        share = [weights[name][members.index(b)] for b in here] if weights else [1.0 / len(here)] * len(here)
        total = F.lit(0.0)
        for b, w in zip(here, share, strict=True):
            total = total + v[bands.index(b)] * w
        out[name] = total
    return out


def stretch(v: Column, low: Column, high: Column) -> Column:
    """Linear to 0..255, clipped."""
    return F.greatest(F.least((v - low) / (high - low) * 255.0, F.lit(255.0)), F.lit(0.0))


def stretch_bins(v: Column, low: Column, high: Column) -> Column:
    """To one of 256 equal bins."""
    return F.greatest(F.least(F.floor((v - low) / (high - low) * 256.0), F.lit(255)), F.lit(0)).cast("int")


def super_intensity(intensity: Column) -> Column:
    return intensity * intensity


def class_intensity(cls: Column) -> Column:
    return 1.0 / cls


def total_radiance(columns: dict[str, Column]) -> Column:
    """Sum of the bands' radiances, skipping missing ones."""
    out = F.lit(0.0)
    for c in columns.values():
        out = out + F.coalesce(c, F.lit(0.0))
    return out


# ---- free expressions -------------------------------------------------------------------------

_TOKEN = re.compile(r"\s*(?:(\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+)|([A-Za-z_]\w*(?:\.[A-Za-z]\w*)?)|(<=|>=|==|!=|&&|\|\||[-+*/%()<>?:,!]))")
_FUNCTIONS = {
    "abs": F.abs, "sqrt": F.sqrt, "exp": F.exp, "log": F.ln, "sin": F.sin, "cos": F.cos, "tan": F.tan, "floor": F.floor, "ceil": F.ceil,
    "pow": F.pow, "min": F.least, "max": F.greatest, "atan2": F.atan2,
}
_LEVELS = (("||",), ("&&",), ("==", "!=", "<", "<=", ">", ">="), ("+", "-"), ("*", "/", "%"))
_OPS = {
    "||": lambda a, b: a | b, "&&": lambda a, b: a & b, "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "+": lambda a, b: a + b, "-": lambda a, b: a - b,
    "*": lambda a, b: a * b, "/": F.try_divide, "%": lambda a, b: a % b,
}


class Expression:
    """An arithmetic expression over band names, parsed into a Column; nothing else gets through.

    Numbers, bands, + - * / %, comparisons, && || !, ?:, parentheses, pi, e and the usual
    functions, with or without `Math.` in front."""

    def __init__(self, text: str, bands: list[str]):
        self.bands, self.used, self.at = bands, [], 0
        self.tokens: list[str] = []
        pos = 0
        while pos < len(text.rstrip()):
            m = _TOKEN.match(text, pos)
            if not m:
                raise ValueError(f"unexpected {text[pos:]!r}")
            self.tokens.append(m[m.lastindex])
            pos = m.end()
        self.bare = len(self.tokens) == 1 and self.tokens[0] in bands
        self.tree = self._choice()
        if self.at != len(self.tokens):
            raise ValueError(f"unexpected {self.tokens[self.at]!r}")

    def column(self, value) -> Column:
        """`value(band)` gives a band's column."""
        return self._build(self.tree, value)

    def _peek(self) -> str:
        return self.tokens[self.at] if self.at < len(self.tokens) else ""

    def _next(self, want: str = "") -> str:
        got = self._peek()
        if not got or want and got != want:
            raise ValueError(f"expected {want or 'more'}, found {got or 'the end'}")
        self.at += 1
        return got

    def _choice(self):
        test = self._binary(0)
        if self._peek() != "?":
            return test
        self._next()
        yes = self._choice()
        self._next(":")
        return ("?", test, yes, self._choice())

    def _binary(self, level: int):
        if level == len(_LEVELS):
            return self._unary()
        left = self._binary(level + 1)
        while self._peek() in _LEVELS[level]:
            op = self._next()
            left = (op, left, self._binary(level + 1))
        return left

    def _unary(self):
        if self._peek() in ("-", "!", "+"):
            return ("u" + self._next(), self._unary())
        token = self._next()
        if token == "(":
            inner = self._choice()
            self._next(")")
            return inner
        if token[0].isdigit() or token[0] == ".":
            return ("n", float(token))
        if token in self.bands:
            if token not in self.used:
                self.used.append(token)
            return ("b", token)
        name = token.removeprefix("Math.")
        if name in ("PI", "pi", "E", "e"):
            return ("n", math.pi if name.lower() == "pi" else math.e)
        if name in _FUNCTIONS and self._peek() == "(":
            self._next()
            args = [self._choice()]
            while self._peek() == ",":
                self._next()
                args.append(self._choice())
            self._next(")")
            return ("f", name, args)
        raise ValueError(f"unknown name {token!r}")

    def _build(self, t, value) -> Column:
        kind = t[0]
        if kind == "n":
            return F.lit(t[1])
        if kind == "b":
            return value(t[1])
        if kind == "f":
            return _FUNCTIONS[t[1]](*(self._build(a, value) for a in t[2]))
        if kind == "?":
            return F.when(self._build(t[1], value), self._build(t[2], value)).otherwise(self._build(t[3], value))
        if kind[0] == "u" and len(t) == 2:
            x = self._build(t[1], value)
            return {"u-": lambda: -x, "u!": lambda: ~x, "u+": lambda: x}[kind]()
        return _OPS[kind](self._build(t[1], value), self._build(t[2], value))
