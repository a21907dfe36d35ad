"""Row rules as Column expressions. In every table of rules the first match wins.

A comparison with null is unknown, so a reading with missing values falls through to
the default unless another alternative of a rule is met.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(cases, default) -> Column:
    """CASE over (condition, value) pairs."""
    out = None
    for condition, value in cases:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(default)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _outside(c: Column, low: float) -> Column:
    return (c == 0) | (c > low)


# The ladders of the four classifications, first match wins. Bounds are clinical limits in mmHg.
# (name, SBP from, SBP below, DBP from, DBP below, "and" / "or"); None leaves a side open.
BP_LEVELS = (
    ("Normal", None, 120, None, 80, "and"),
    ("Elevated", 120, 130, None, 80, "and"),
    ("Stage 1 Hypertension", 130, 140, 80, 90, "or"),
    ("Stage 2 Hypertension", 140, None, 90, None, "or"),
)
BP_LEVEL_REST = "Hypertensive Crisis"
# (name, SBP reaches, DBP reaches), worst first; a crisis needs more than its bounds.
BP_CRISIS = ("Hypertensive Crisis", 180, 120)
BP_STAGES = (("Hypertension Stage 2", 140, 90), ("Hypertension Stage 1", 130, 80))
# (SBP from, SBP to with the bound itself, DBP below) of "Elevated": with and without a zero class.
BP_ELEVATED = (120, 130, 80)
BP_ELEVATED_ZERO = (120, 129, 80)
BP_NORMAL = ("Normal", 120, 80)
# (name, SBP below, DBP below)
BP_UPPER = (("Normal", 120, 80), ("Elevated", 129, 89), ("Hypertension Stage 1", 139, 89))
BP_UPPER_REST = "Hypertension Stage 2 or higher"


def _range(c: Column, low, high) -> Column:
    """low <= c < high; an open side is not tested."""
    tests = [t for t in (None if low is None else c >= low, None if high is None else c < high) if t is not None]
    return tests[0] if len(tests) == 1 else tests[0] & tests[1]


def bp_level(s, d) -> Column:
    """Five pressure levels; the last one is what remains, in practice missing values."""
    s, d = _col(s), _col(d)
    cases = []
    for name, s_low, s_high, d_low, d_high, both in BP_LEVELS:
        in_s, in_d = _range(s, s_low, s_high), _range(d, d_low, d_high)
        cases.append((in_s & in_d if both == "and" else in_s | in_d, name))
    return first_match(cases, BP_LEVEL_REST)


def _ladder(s, d, elevated, zero: bool) -> Column:
    name, s_max, d_max = BP_CRISIS
    cases = [((s > s_max) | (d > d_max), name)]
    for name, s_min, d_min in BP_STAGES:
        cases.append(((s >= s_min) | (d >= d_min), name))
        if zero and name == BP_STAGES[0][0]:
            cases.append(((s == 0) | (d == 0), "Dead"))
    low, high, below = elevated
    cases.append(((s >= low) & (s <= high) & (d < below), "Elevated"))
    name, s_below, d_below = BP_NORMAL
    return first_match([*cases, ((s < s_below) & (d < d_below), name)], "Uncategorized")


def bp_class(s, d) -> Column:
    """Clinical order, worst first."""
    return _ladder(_col(s), _col(d), BP_ELEVATED, zero=False)


def bp_class_zero(s, d) -> Column:
    """As bp_class with a zero class after stage 2; 129 < SBP < 130 has no class."""
    return _ladder(_col(s), _col(d), BP_ELEVATED_ZERO, zero=True)


def bp_class_validity(s, d, hr, spo2) -> Column:
    """Upper-bound classes, preceded by a check for a lost pressure signal."""
    s, d, hr, spo2 = map(_col, (s, d, hr, spo2))
    lost = (s == 0) & (d == 0) & _outside(hr, 80) & _outside(spo2, 80)
    return first_match([(lost, "Invalid Measurement")] + [((s < a) & (d < b), name) for name, a, b in BP_UPPER], BP_UPPER_REST)


def label_threshold(s, d, hr) -> Column:
    """0 = normal pressure, 1 = anything else; a lost signal counts as 1 when HR >= 80."""
    s, d, hr = _col(s), _col(d), _col(hr)
    lost = (s == 0) & (d == 0) & (hr >= 80)
    return first_match([(lost, 1), ((s < 120) & (d < 80), 0)], 1)


def label_not_normal(cls) -> Column:
    """1 where the class is anything but Normal (a missing class too)."""
    return F.when(_col(cls) == "Normal", 0).otherwise(1)


def label_online(s, d) -> Column:
    """Truth used while scoring messages: normal needs both below the limit and not zero."""
    s, d = _col(s), _col(d)
    normal = (s < 120) & (d < 80) & (s != 0) & (d != 0)
    return F.when(normal, 0).otherwise(1)


def sbp_band(s) -> Column:
    """1 low, 2 high, 3 very high."""
    s = _col(s)
    return first_match([(s > 80, 3), (s > 50, 2)], 1).cast("int")


def score_flag(score, bands, floor) -> Column:
    """1 where a score lies strictly inside one of the bands or below the floor."""
    score = _col(score)
    hit = score < floor
    for low, high in bands:
        hit = hit | ((score > low) & (score < high))
    return F.when(hit, 1).otherwise(0)


def detection_flag(pred) -> Column:
    """Outlier code -1 becomes 1, everything else 0."""
    return F.when(_col(pred) == -1, 1).otherwise(0)


def detection_label(pred) -> Column:
    return value_map(detection_flag(pred), {0: "Normal", 1: "Anomaly"})


def value_map(c, mapping: dict) -> Column:
    """Exact value to text; values without an entry become null."""
    c = _col(c)
    return first_match([(c == k, v) for k, v in mapping.items()], None)


def range_map(c, ranges) -> Column:
    """(low, high, text), both ends inclusive; gaps become null."""
    c = _col(c)
    return first_match([(c.between(lo, hi), out) for lo, hi, out in ranges], None)


def threshold_band(c, steps) -> Column:
    """Text of the highest step not above the value; the step with value None is the base."""
    c = _col(c)
    base = next((out for v, out in steps if v is None), None)
    rising = sorted(((v, out) for v, out in steps if v is not None), reverse=True)
    return F.when(c.isNull(), None).otherwise(first_match([(c >= v, out) for v, out in rising], base))


def relabel(df, column: str, mapping: dict):
    """Replace listed values of a text column, keep the others."""
    c = F.col(column)
    return df.withColumn(column, first_match([(c == k, v) for k, v in mapping.items()], c))


# Dashboard steps (lower bound, colour) and ranges (low, high, colour).
SBP_STEPS = ((None, "green"), (120, "#EAB839"), (130, "dark-orange"), (140, "red"), (180, "#710f0f"))
DBP_STEPS = ((None, "green"), (80, "semi-dark-orange"), (90, "red"), (120, "#601010"))
HR_STEPS = ((None, "green"), (0, "red"), (60, "green"), (100, "red"))
RR_STEPS = ((None, "green"), (0, "dark-red"), (12, "green"), (20, "dark-red"))
CO_STEPS = ((None, "green"), (0, "dark-red"), (4000, "green"), (8000, "red"))
SPO2_STEPS = ((None, "red"), (85, "#EAB839"), (94, "green"))
SPO2_RANGES = ((0, 85, "red"), (85, 94, "yellow"), (95, 100, "green"))
