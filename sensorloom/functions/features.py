"""Names of the per-bucket features.

Every feature has an ASCII name; the Chinese names under which dashboards and
stored configurations ask for the same features are accepted as well and then
also used as the output column name.
"""

from __future__ import annotations

# Feature names as stored in existing configurations and facts.
FEATURE_ALIASES = {
    "均值": "mean",
    "中位数": "median",
    "最大值": "max",
    "最小值": "min",
    "Q1": "q1",
    "Q3": "q3",
    "P10": "p10",
    "超过Q3占时比": "share_above_q3",
    "极差": "range",
    "标准差": "std",
    "平均绝对偏差_均值": "mad_mean",
    "平均绝对偏差_中位数": "mad_median",
    "变异系数": "cv",
    "一阶自相关": "lag1_autocorr",
}

FEATURES = tuple(FEATURE_ALIASES.values())
RANGE_RATE = "range_rate"
RANGE_RATE_ALIAS = "极差的时间变化率"

VOLATILITY_DEFAULT = ("std", "cv", "lag1_autocorr", "mad_mean", "mad_median")
SINGLE_WINDOW = ("mean", "median", "max", "min", "q1", "q3", "p10", "range", "share_above_q3")

# features the request interface accepts
REQUEST_FEATURES = ("mean", "median", "max", "min", "std", "q1", "q3", "p10", "share_above_q3")
REQUEST_FREQUENCIES = ("h", "D", "W", "M", "ME", "MS")


def canonical(name: str) -> str | None:
    """Registry name for a requested feature name, None if unknown."""
    if name in FEATURES:
        return name
    return FEATURE_ALIASES.get(name)


def resolve(names) -> dict[str, str]:
    """Requested name -> registry name, unknown names left out, order kept."""
    return {n: canonical(n) for n in names if canonical(n)}
