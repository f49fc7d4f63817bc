"""Bronze -> silver: population, trim, parse, group, impute, fill.

``fit_silver`` learns the few things the stage needs (salary bounds, rare
countries, medians) and ``SilverModel.transform`` applies them, so the same
fit can be replayed on new rows (for example scoring requests).
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysight.functions.parse import age_to_double, years_to_double
from paysight.operators.filters import population_filter
from paysight.operators.quantiles import DEFAULT_REL_ERROR
from paysight.operators.rare import kept_values
from paysight.operators.text import fill_text
from paysight.operators.trim import Bounds, apply_bounds, apply_medians, fit_bounds, fit_medians
from paysight.runtime import SmallTable, stage_table
from paysight.schema import CORE_COLUMNS, SKILL_COLUMNS, TARGET, select_available

# Parsed columns and their sources.
PARSED = [("YearsCodePro", "YearsCodeProNum", "years"), ("YearsCode", "YearsCodeNum", "years"), ("Age", "AgeNum", "age")]
IMPUTED = ["YearsCodeProNum", "YearsCodeNum", "AgeNum"]


def parse_columns(df: DataFrame) -> DataFrame:
    """Add the numeric parses of whichever source columns exist."""
    out = df
    for src, dst, kind in PARSED:
        if src in df.columns:
            fn = years_to_double if kind == "years" else age_to_double
            out = out.withColumn(dst, fn(src))
    return out


@dataclass
class SilverParams:
    trim_lower: float = 0.01
    trim_upper: float = 0.99
    rel_error: float = DEFAULT_REL_ERROR
    min_country: int = 100
    keep: list[str] = field(default_factory=lambda: ["ResponseId", *CORE_COLUMNS])
    population: dict = field(default_factory=dict)


@dataclass
class SilverModel:
    params: SilverParams
    bounds: Bounds | None
    kept: SmallTable | None
    medians: dict[str, float]

    def transform(self, df: DataFrame, filter_rows: bool = True) -> DataFrame:
        core = select_available(df, self.params.keep)
        if filter_rows:
            core = apply_bounds(population_filter(core, **self.params.population), self.bounds)
        return self.finish(core)

    def finish(self, core: DataFrame) -> DataFrame:
        """Parse, group, impute and fill rows that are already filtered and trimmed."""
        parsed = parse_columns(core)
        grouped = self._group(parsed)
        present = [c for c in IMPUTED if c in grouped.columns]
        imputed = apply_medians(grouped, {c: m for c, m in self.medians.items() if c in present})
        for c in present:
            if c not in self.medians:
                imputed = imputed.withColumn(c + "_imp", F.col(c))
        return fill_text(imputed, SKILL_COLUMNS)

    def _group(self, df: DataFrame) -> DataFrame:
        """A country that was not frequent in the fit, or not there at all, is ``Other``; null stays null."""
        if "Country" not in df.columns or self.kept is None:
            return df
        kept = self.kept.for_join().withColumn("_kept_hit", F.lit(True))
        joined = df.join(kept, df["Country"] == kept["_kept_value"], "left")
        other = F.col("Country").isNotNull() & F.col("_kept_hit").isNull()
        return joined.withColumn("CountryGrouped", F.when(other, F.lit("Other")).otherwise(F.col("Country"))).drop("_kept_value", "_kept_hit")

    def save(self, spark: SparkSession, path: str) -> None:
        """The fit as Parquet: its parameters and scalars as one JSON text, and the kept countries."""
        state = {"params": asdict(self.params), "bounds": asdict(self.bounds) if self.bounds else None, "medians": self.medians, "grouped": self.kept is not None}
        spark.createDataFrame([(json.dumps(state),)], "state string").write.mode("overwrite").parquet(f"{path}/state")
        if self.kept is not None:
            self.kept.df.write.mode("overwrite").parquet(f"{path}/kept")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SilverModel:
        state = json.loads(spark.read.parquet(f"{path}/state").first()["state"])
        bounds = Bounds(**state["bounds"]) if state["bounds"] else None
        kept = SmallTable(spark.read.parquet(f"{path}/kept")) if state["grouped"] else None
        return cls(SilverParams(**state["params"]), bounds, kept, state["medians"])


def fit_silver(df: DataFrame, params: SilverParams | None = None) -> SilverModel:
    """Fit bounds on the population, then frequent countries and medians on the
    trimmed, parsed rows (the order the stage applies them)."""
    params = params or SilverParams()
    return _fit(population(df, params), params)


def population(df: DataFrame, params: SilverParams) -> DataFrame:
    return population_filter(select_available(df, params.keep), **params.population)


def _fit(pop: DataFrame, params: SilverParams) -> SilverModel:
    bounds = fit_bounds(pop, TARGET, params.trim_lower, params.trim_upper, params.rel_error) if TARGET in pop.columns else None
    parsed = parse_columns(apply_bounds(pop, bounds))
    kept = SmallTable(kept_values(parsed, "Country", params.min_country)) if "Country" in parsed.columns else None
    medians = fit_medians(parsed, [c for c in IMPUTED if c in parsed.columns], params.rel_error)
    return SilverModel(params, bounds, kept, medians)


def silver_and_model(df: DataFrame, params: SilverParams | None = None) -> tuple[DataFrame, SilverModel]:
    """The whole silver stage on ``df``, and its fit.

    The filtered projection is written once; every fitting pass and the result read that table,
    so the input and the joins behind it run a single time."""
    params = params or SilverParams()
    pop = stage_table(population(df, params), "silver-population")
    model = _fit(pop, params)
    return model.finish(apply_bounds(pop, model.bounds)), model


def silver(df: DataFrame, params: SilverParams | None = None) -> DataFrame:
    """The whole silver stage on ``df``."""
    return silver_and_model(df, params)[0]
