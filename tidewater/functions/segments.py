"""Uplift segment, reason text and description column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.text import _c, literal_lookup

# ---------------------------------------------------------------------------
# These must equal the reference's for identical results.
THRESHOLD = 0.5
PERSUADABLE, SURE_THING, LOST_CAUSE, SLEEPING_DOG = "persuadible", "sure_thing", "lost_cause", "sleeping_dog"
SEGMENTS = [PERSUADABLE, SURE_THING, LOST_CAUSE, SLEEPING_DOG]
# Reason sentences; {c} = control probability, {t} = treated probability, {g} = signed gap.
REASONS = {
    PERSUADABLE: "probabilidad de aumentar uso sube de {c} (sin tarjeta) a {t} (con tarjeta)",
    SURE_THING: "probablemente aumentaría el uso de todas formas ({c} sin tarjeta, {t} con tarjeta)",
    LOST_CAUSE: "baja probabilidad de aumentar uso con ({t}) o sin ({c}) tarjeta",
    SLEEPING_DOG: "la tarjeta podría REDUCIR la probabilidad de aumentar uso ({c} sin tarjeta vs. {t} con tarjeta, gap={g})",
}
DESCRIPTIONS = {
    PERSUADABLE: "Alta prioridad: es más probable que aumente su actividad SI recibe la tarjeta física, y no lo haría por su cuenta.",
    SURE_THING: "Baja prioridad: probablemente aumentaría su actividad con o sin la tarjeta -- darle la tarjeta no cambia el resultado.",
    LOST_CAUSE: "Baja prioridad: es poco probable que aumente su actividad, con o sin la tarjeta.",
    SLEEPING_DOG: "No priorizar: el modelo estima que darle la tarjeta podría REDUCIR su actividad respecto a dejarlo solo con virtual.",
}
# ---------------------------------------------------------------------------


def segment(p_t, p_c, threshold: float = THRESHOLD) -> Column:
    """quadrant of (treated, control) probabilities; the threshold is inclusive."""
    hi_t, hi_c = _c(p_t) >= threshold, _c(p_c) >= threshold
    return (F.when(hi_t & ~hi_c, PERSUADABLE).when(hi_t & hi_c, SURE_THING)
             .when(~hi_t & ~hi_c, LOST_CAUSE).otherwise(SLEEPING_DOG))


def pct_text(p) -> Column:
    """Whole percent, half-even (as Python's ``{:.0%}``): 0.125 -> '12%'."""
    return F.format_string("%d%%", F.bround(_c(p) * 100, 0).cast("long"))


def signed_pct_text(p) -> Column:
    return F.format_string("%+d%%", F.bround(_c(p) * 100, 0).cast("long"))


def _fill(template: str, c: Column, t: Column, g: Column) -> Column:
    parts, rest = [], template
    subs = {"{c}": c, "{t}": t, "{g}": g}
    while rest:
        idx = [(rest.find(k), k) for k in subs if rest.find(k) >= 0]
        if not idx:
            parts.append(F.lit(rest))
            break
        i, k = min(idx)
        if i:
            parts.append(F.lit(rest[:i]))
        parts.append(subs[k])
        rest = rest[i + len(k):]
    return F.concat(*parts)


def reason_text(seg, p_t, p_c) -> Column:
    """per-segment sentence with the two probabilities (and the signed gap for sleeping dogs)."""
    c, t = pct_text(p_c), pct_text(p_t)
    g = signed_pct_text(_c(p_t) - _c(p_c))
    s = _c(seg)
    expr = None
    for name in SEGMENTS:
        sentence = _fill(REASONS[name], c, t, g)
        expr = F.when(s == name, sentence) if expr is None else expr.when(s == name, sentence)
    return expr


def describe_segment(seg) -> Column:
    """fixed description; unknown segment -> empty text."""
    return F.coalesce(literal_lookup(seg, DESCRIPTIONS), F.lit(""))


def calibrate(p, base_rate) -> Column:
    """Undo balanced class weights: p' = p*pi / (p*pi + (1-p)*(1-pi))."""
    p, pi = _c(p), F.lit(base_rate) if not isinstance(base_rate, Column) else base_rate
    num = p * pi
    return F.try_divide(num, num + (1 - p) * (1 - pi))
