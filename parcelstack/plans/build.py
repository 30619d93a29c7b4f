"""The lead build job: feeds in, ranked lead records out.

    parcels   = clean + first row per pid, stored as Parquet (like every stage
              table: feeds, evidence, scored, records)
    evidence  = pid-keyed feeds  JOIN parcels.pid          (one join, AQE skew split)
              + sale notices     JOIN address index        (num, street)
              + estate notices   JOIN owner-key index      (name key)
    links (evidence and the rows that found no parcel, which metrics count) are
    stored once: the fold, the top-signal window and the metrics all read them, and a lost executor recomputes from it, not from the feeds. Both
    shuffle pre-reduced rows only (partial aggregate / partial group limit).
    fold -> JOIN parcels (scores, transfer rules) -> records -> rank
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import link, parcels as P, rank, score
from ..operators.keyfilter import key_words
from ..session import ensure_checkpoint_dir
from ..sources.feeds import Feeds


def materialize(df: DataFrame) -> DataFrame:
    """A stage table: Parquet in the cluster's shared folder, read back, so
    later scans read only the columns they use."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/parcelstack-stage/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@dataclass
class LeadBuild:
    parcels: DataFrame
    links: DataFrame
    evidence: DataFrame
    scored: DataFrame
    top: DataFrame
    records: DataFrame
    pid_words: tuple[DataFrame, int] | None = None

    def ranked(self) -> DataFrame:
        return rank.rank_leads(self.records)


def pid_filter(parcels: DataFrame, store=lambda df: df) -> tuple[DataFrame, int] | None:
    """`key_words` of the pids of a stored parcel table; `store` keeps the table."""
    words = key_words(parcels.select(F.array("pid").alias("keys")), "keys")
    return words and (store(words[0]), words[1])


def build_links(feeds: Feeds, parcels: DataFrame, county: str = K.DEFAULT_COUNTY,
                dedup_cases: bool = False, store=lambda df: df, pid_words=None) -> DataFrame:
    """Every feed row's links to parcels, with those that found none: evidence
    and match metrics both come from here. `store` keeps the estate notices
    with their keys, which are exploded next; `pid_words`: see `pid_filter`."""
    open_ = [link.tax_candidates(feeds.tax, county), link.demo_candidates(feeds.code_demos), link.instrument_candidates(feeds.instruments)]
    cands = reduce(DataFrame.unionByName, [c.withColumn("ok", F.lit(True)) for c in open_])
    cands = cands.unionByName(link.code_candidates(feeds.code_cases, open_only=False, dedup_cases=dedup_cases))
    by_addr = link.link_by_address(link.foreclosure_notices(feeds.foreclosures, county), P.address_index(parcels))
    notices = store(link.estate_notices(feeds.estates, county).select(*link.NOTICE_COLS, "keys"))
    by_name = link.link_by_name(notices, P.owner_key_index(parcels, key_words(notices, "keys")))
    return reduce(DataFrame.unionByName, [link.link_by_pid(cands, parcels, pid_words), by_addr, by_name])


def build_evidence(feeds: Feeds, parcels: DataFrame, county: str = K.DEFAULT_COUNTY,
                   dedup_cases: bool = False) -> DataFrame:
    return link.evidence_of(build_links(feeds, parcels, county, dedup_cases))


def build_leads(feeds: Feeds, as_of: str, county: str = K.DEFAULT_COUNTY,
                checkpoint: bool = True, dedup_cases: bool = False, weights: dict | None = None,
                parcels: DataFrame | None = None) -> LeadBuild:
    """The whole lead build. `as_of` is the run's 'now' (UTC date);
    `county` the notice feeds' county; `dedup_cases` counts each code case
    once (latest row) instead of once per ingested row; `weights` overrides
    score weights by name (see `score.WEIGHT_KEYS`); `parcels` is the stored
    table of `clean_parcels` where there is one already."""
    if parcels is None:
        parcels = P.clean_parcels(feeds.parcels_raw)
        if checkpoint:
            parcels = materialize(parcels)
    pid_words = pid_filter(parcels, materialize) if checkpoint else None
    links = build_links(feeds, parcels, county, dedup_cases, materialize if checkpoint else lambda df: df, pid_words)
    if checkpoint:
        links = materialize(links)
    ev = link.evidence_of(links)
    scored = score.score_leads(score.fold(ev), parcels, as_of, weights)
    if checkpoint:
        scored = materialize(scored)
    sig = ev.where(F.col("pattern").isNotNull()).unionByName(score.transfer_evidence(scored))
    top = rank.top_signals(sig)
    records = rank.lead_records(scored, rank.signals_map(top))
    if checkpoint:
        # the build's output table (S7 writes it); reports and exports read it
        records = materialize(records)
    return LeadBuild(parcels=parcels, links=links, evidence=ev, scored=scored, top=top, records=records,
                     pid_words=pid_words)


def run_job(spark, paths: dict, out_dir: str, as_of: str, county: str = K.DEFAULT_COUNTY,
            run_id: str = "", export_filter: dict | None = None, dedup_cases: bool = False) -> LeadBuild:
    """E1 end to end: JSON-lines feeds (missing optional feeds are empty) ->
    lead build -> ranked records + run summary (+ filtered CSV export) under
    `out_dir`. `paths` keys: parcels (required), tax, foreclosures, estates,
    code_cases, code_demos, instruments."""
    from ..operators import report
    from ..session import configure
    from ..sources.feeds import load_feeds
    configure(spark)
    b = build_leads(load_feeds(spark, paths), as_of, county, dedup_cases=dedup_cases)
    report.write_outputs(b.ranked(), report.run_summary(b.records, run_id), out_dir)
    if export_filter is not None:
        report.write_export_csv(b.records, export_filter, f"{out_dir}/export")
    return b
