"""Composite jobs: bronze -> silver, and the whole run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from offerlake.operators import sites
from offerlake.operators.clean import standardize
from offerlake.operators.dedup import deduplicate, single_source
from offerlake.operators.schema import SILVER_SCHEMA, ensure_schema
from offerlake.plans.gold import ml_dataset, price_analytics, sorted_for_write
from offerlake.session import shuffle_partitions
from offerlake.sources import lake
from offerlake.sources.bronze import read_bronze


def bronze_to_silver(
    df: DataFrame,
    source: str | None = None,
    order_by: Sequence[str] = ("date_scraped",),
    compat_dates: bool = False,
) -> DataFrame:
    """Standardise (P5), deduplicate (D3), type (B12), site rules (D6), fit to silver (P10).

    The site is checked on the raw source column before any cleaning, so the
    guard is a one-column scan and the cleaning plan runs once, in the write.
    Two shuffles (one per dedup key); everything else is narrow.
    """
    site = single_source(df) if source is None else source
    out = standardize(df)
    out = deduplicate(out, order_by=order_by)
    out = sites.shared_rules(out, compat_dates=compat_dates)
    out = sites.site_rules(out, site)
    return ensure_schema(out, SILVER_SCHEMA)


def write_silver(silver: DataFrame, paths: lake.LakePaths, fmt: str = lake.DEFAULT_FORMAT, append: bool = False) -> str:
    """Silver is partitioned by source; by default a run replaces only its own
    source's partition (dynamic overwrite), so reruns do not double the table."""
    if append:
        lake.append_table(silver, paths.silver, fmt, partition_by=("offer_source",))
    else:
        lake.overwrite_table(silver, paths.silver, fmt, partition_by=("offer_source",), dynamic=True)
    return paths.silver


def run_pipeline(
    spark: SparkSession,
    root: str,
    fmt: str = lake.DEFAULT_FORMAT,
    sites_in_order: Sequence[str] = ("olx", "otodom"),
    order_by: Sequence[str] = ("date_scraped",),
    compat_dates: bool = False,
    train: bool = True,
    train_kwargs: dict | None = None,
    partitions: int | None = None,
    incremental: bool = False,
) -> dict:
    """Bronze -> silver for each site, both gold tables, then the price model.

    Every stage hands over a written table (the lineage is cut at each write),
    so a lost executor only re-runs the current stage.  Bronze is read with its
    site's stored schema, promoted columns included (S5).  ``partitions`` sets the shuffle partitions of the
    silver build, whose shuffles carry whole bronze rows
    (``session.shuffle_partitions_for`` gives a number that fits a table).
    ``incremental`` takes only the micro-batches that bronze has got since the last
    run (``plans.incremental``) instead of building silver from all of it.
    """
    from offerlake.operators import ml  # heavy import only when training
    from offerlake.plans.incremental import update_silver

    paths = lake.LakePaths(root)
    for site in sites_in_order:
        if incremental:
            with shuffle_partitions(spark, partitions):
                update_silver(spark, paths, site, fmt, order_by=order_by, compat_dates=compat_dates)
            continue
        bronze = read_bronze(spark, paths, site, fmt)  # the stored schema: no footer is opened to find it
        found = single_source(bronze)  # D5 on the raw source column: a one-column scan
        if found != site:
            raise ValueError(f"bronze table of {site!r} holds offers of {found!r}")
        with shuffle_partitions(spark, partitions):
            write_silver(bronze_to_silver(bronze, site, order_by=order_by, compat_dates=compat_dates), paths, fmt)
    silver = lake.read_table(spark, paths.silver, fmt)
    lake.overwrite_table(sorted_for_write(price_analytics(silver, sort=False)), paths.gold_analytics, fmt)
    lake.overwrite_table(ml_dataset(silver), paths.gold_ml, fmt)
    result = {"silver": paths.silver, "analytics": paths.gold_analytics, "ml": paths.gold_ml}
    if train:
        gold = lake.read_table(spark, paths.gold_ml, fmt)
        # A table scan: no second copy.  A restarted run goes on from the ledger of finished fits.
        fit = ml.train_price_model(gold, stored=True, **{"ledger": paths.search_ledger, **(train_kwargs or {})})
        ml.save_model(fit.model, paths.model)
        result["model"] = paths.model
        result["rmse"] = fit.best_rmse
    return result
