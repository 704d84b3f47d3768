"""Reading rules as column expressions: no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits, tolerances, codes and messages of the rules.
KWH_RANGE = (0.0, 50.0)
VOLTAGE_RANGE = (200.0, 240.0)
CURRENT_RANGE = (0.0, 100.0)
POWER_TOLERANCE = 0.15
KWH_JUMP = 0.5
VOLTAGE_JUMP = 0.1
NO_INPUT = -1
OK = 0
KWH_OUT_OF_RANGE = 1
VOLTAGE_OUT_OF_RANGE = 2
CURRENT_OUT_OF_RANGE = 3
POWER_MISMATCH = 4
ANOMALY = 5
MESSAGES = {
    OK: "No error",
    KWH_OUT_OF_RANGE: "Power consumption out of valid range",
    VOLTAGE_OUT_OF_RANGE: "Voltage out of valid range",
    CURRENT_OUT_OF_RANGE: "Current out of valid range",
    POWER_MISMATCH: "Power calculation mismatch",
    ANOMALY: "Anomaly detected in readings",
}
UNKNOWN_MESSAGE = "Unknown error"

NAN_MODES = ("reject", "pass")


def _check_nan_mode(nan: str) -> None:
    if nan not in NAN_MODES:
        raise ValueError(f"nan must be one of {NAN_MODES}, not {nan!r}")


def _known(condition: str, value: str, nan: str) -> str:
    """`condition`, which in `pass` mode does not hold where `value` is NaN.

    Spark orders NaN above all numbers, so that comparisons with it hold;
    in IEEE arithmetic they do not.
    """
    return condition if nan == "reject" else f"({condition}) and not isnan({value})"


POWER = "voltage * current / 1000.0D"
DIFFERENCE = f"abs({POWER} - kwh)"
TOLERANCE = f"kwh * {POWER_TOLERANCE}D"


def _outside(name: str, limits: tuple[float, float]) -> str:
    return f"{name} not between {limits[0]}D and {limits[1]}D"


def error_code(nan: str = "reject") -> Column:
    """Code of the first rule that fails; 0 if none does, -1 if a measure is null."""
    _check_nan_mode(nan)
    rules = [
        ("kwh is null or voltage is null or current is null", NO_INPUT),
        (_known(_outside("kwh", KWH_RANGE), "kwh", nan), KWH_OUT_OF_RANGE),
        (_known(_outside("voltage", VOLTAGE_RANGE), "voltage", nan), VOLTAGE_OUT_OF_RANGE),
        (_known(_outside("current", CURRENT_RANGE), "current", nan), CURRENT_OUT_OF_RANGE),
        (_known(f"{DIFFERENCE} > {TOLERANCE}", DIFFERENCE, nan), POWER_MISMATCH),
    ]
    cases = " ".join(f"when {failed} then {number}" for failed, number in rules)
    return F.expr(f"case {cases} else {OK} end")


def error_message(code: Column) -> Column:
    text = None
    for number, message in MESSAGES.items():
        hit = code == number
        text = F.when(hit, message) if text is None else text.when(hit, message)
    return text.otherwise(UNKNOWN_MESSAGE)


def error_text(code: Column) -> Column:
    """The full text of a rejected reading."""
    return F.concat(
        F.lit("validation error ["), code.cast("string"), F.lit("]: "), error_message(code)
    )


def with_validation(readings: DataFrame, nan: str = "reject") -> DataFrame:
    """Add `error_code` and `is_valid`; one output row per input row."""
    return readings.withColumn("error_code", error_code(nan)).withColumn(
        "is_valid", F.col("error_code") == OK
    )


def with_power_check(readings: DataFrame) -> DataFrame:
    return readings.withColumns(
        {
            "calculated_power": F.expr(POWER),
            "power_diff": F.expr(DIFFERENCE),
            "tolerance": F.expr(TOLERANCE),
        }
    )


def _validated(readings: DataFrame, nan: str) -> DataFrame:
    return readings if "error_code" in readings.columns else with_validation(readings, nan)


def valid_only(readings: DataFrame, nan: str = "reject") -> DataFrame:
    """The readings that pass, in their own columns."""
    return _validated(readings, nan).filter("error_code = 0").select(readings.columns)


def rejected(readings: DataFrame, nan: str = "reject") -> DataFrame:
    """The readings that fail, with the code and its text."""
    bad = _validated(readings, nan).filter("error_code <> 0")
    return bad.withColumn("error_text", error_text(F.col("error_code")))


def _jumped(now: str, before: str, limit: float, nan: str) -> str:
    """The relative change exceeds the limit. From zero, every change does."""
    ratio = f"abs(try_divide({now} - {before}, {before}))"
    moved = _known(f"{now} <> {before}", now, nan)
    return f"if({before} = 0, {moved}, {_known(f'{ratio} > {limit}D', ratio, nan)})"


def anomaly_code(previous: str, nan: str = "reject") -> Column:
    """Compare a row with the previous kwh and voltage, fields of the struct column
    `previous`; -1 without one."""
    _check_nan_mode(nan)
    pairs = [("kwh", KWH_JUMP), ("voltage", VOLTAGE_JUMP)]
    missing = [f"{c} is null or {previous}.{c} is null" for c, _ in pairs]
    jumps = [_jumped(c, f"{previous}.{c}", limit, nan) for c, limit in pairs]
    return F.expr(
        f"case when {' or '.join(missing)} then {NO_INPUT} "
        f"when ({') or ('.join(jumps)}) then {ANOMALY} else {OK} end"
    )
