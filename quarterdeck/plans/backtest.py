"""Point-in-time backtest: the screen rebuilt from a physically truncated copy must equal the full build's."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.operators import panel as p
from quarterdeck.operators import peers, screen
from quarterdeck.sources.writers import frozen_copy, materialized, write_exhibit


class LeakError(ValueError):
    """A score changed when later data was taken away."""


def marts(tables: dict[str, DataFrame], bands=p.BANDS) -> dict[str, DataFrame]:
    """Fact, dimension and flags of staged ``financials``, ``registry`` and ``failures``."""
    fact = materialized(p.build_fact(tables["financials"], tables["registry"], bands))
    return {"fact": fact, "dim": p.dim_entities(tables["registry"], tables["financials"], tables["failures"]), "flags": peers.screen_flags(fact)}


def run_backtest(spark: SparkSession, tables: dict[str, DataFrame], as_of: date, path: str, labels: dict[str, list[int]], bands=p.BANDS, expected: DataFrame | None = None) -> dict[str, DataFrame]:
    """Freeze, rebuild, prove, rank, write exhibits, and hold pinned ranks; raises if scores or ranks moved."""
    cut = frozen_copy(tables, as_of, {"financials": ("report_date", "yyyy-MM-dd")}, f"{path}/raw")
    frozen, full = marts(cut, bands), marts(tables, bands)
    at = lambda m: m["flags"].filter(F.col("report_date") == F.lit(as_of))
    keys = ["cert", "report_date", "peer_band", "n_screen_metrics"]
    if leaks := screen.prove_equivalence(at(frozen), at(full), keys).take(5):
        raise LeakError(str(leaks))
    ranked = screen.rank_screen(frozen["flags"], frozen["dim"], frozen["fact"], as_of)
    listed = [k for group in labels.values() for k in group]
    exhibits = {"ranked_full": ranked, "labeled": screen.labeled_subset(ranked, labels), "false_positives": screen.false_positive_sample(ranked, listed)}
    for name, df in exhibits.items():
        write_exhibit(df, f"{path}/exhibits/{name}")
    if expected is not None and (moved := screen.rank_differences(ranked, expected).take(5)):
        raise LeakError(f"pinned ranks moved: {moved}")
    return exhibits
