"""One call for a whole contract run: the reference's pipeline (scan, profile,
schema view, validate, report, failing rows), over full tables.

Outputs under ``out_base`` (a shared folder on a cluster):
``profiles/``, ``metadata/``, ``sandbox/`` (check results and contract
evaluation), ``failing_examples/`` and, when asked, ``samples/`` for replay.

The check results are written once and read back (a small table, one row per
check): every later step -- contract evaluation, failed-check ids, roll-up --
reads that table instead of re-running the checks, and the lineage is cut at
a written table in the shared folder.
"""

from __future__ import annotations

import os
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from probity.checks import RESULT_DDL, Check
from probity.contract import Contract, load_contract
from probity.operators.profile import PROFILE_DDL, profile_tables
from probity.operators.schema import SCHEMA_VIEW_DDL, schema_view
from probity.plans.compile import validate
from probity.functions.masking import retention_counts
from probity.plans.report import (
    SUGGEST_DDL, contract_evaluation, failed_check_ids, failing_rows, rows_flipped, suggest_checks, suite_change, summary, with_overall,
)
from probity.sources import sinks
from probity.sources.tables import first_n, read_contract_tables, read_table, replay


def run_contract(
    spark: SparkSession,
    contract: str | dict | Contract,
    source_base: str | None,
    out_base: str,
    dataset: str,
    run_id: str | None = None,
    replay_run: bool = False,
    as_of: str | None = None,
    keep_sample: int | None = None,
    failing_n: int | None = None,
    fmt: str = "parquet",
    mask_pii: bool = False,
    with_profile: bool = True,
    validate_sample: bool = False,
    server: str = "mysql",
    num_partitions: int | None = None,
    suite: list[Check] | None = None,
    suggest: bool = False,
) -> dict[str, DataFrame]:
    """Run every rule of ``contract`` over the tables at ``source_base``.

    ``source_base=None`` reads the database that the contract names in
    ``servers.<server>``, each table in ``num_partitions`` ranges of its key.
    ``suite``: a stored suite (``contract.load_suites``) run beside the rules;
    its checks are compared with the rules' checks of the same id, and the
    comparison is written to ``suite_change/``.  ``suggest``: also write the
    checks that the profile suggests, as a stored suite, to ``proposals/``.
    The summary, with one row for the overall verdict, is written too.
    ``replay_run``: skip the scan and validate the samples stored for ``run_id``
    (S12).  ``keep_sample``: also store a deterministic first-N sample per table
    (S2 + S6) so the run can be replayed.  ``mask_pii``: the stored samples and
    failing-row files carry the contract's PII fields masked (C27); checks
    always see the real values.  ``with_profile=False`` skips the profile (its
    own passes over every column) when only the verdicts are wanted.
    ``validate_sample`` (with ``keep_sample``): check the stored sample instead
    of the whole tables, as the reference does -- a later replay of the run then
    gives the very same results."""
    c = contract if isinstance(contract, Contract) else load_contract(contract, as_of=as_of)
    run_id = run_id or datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S")
    tables: dict[str, DataFrame] = {}
    for t in c.tables:
        if replay_run:
            tables[t] = replay(spark, out_base, dataset, t, run_id)
        elif source_base is not None:
            try:
                tables[t] = read_table(spark, source_base, t, fmt)
            except AnalysisException as e:  # an absent table makes its rules ERROR; any other failure ends the run
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
    if source_base is None and not replay_run:
        tables = read_contract_tables(spark, c, server=server, num_partitions=num_partitions)
    from probity.functions.masking import mask_contract_pii

    shown = mask_contract_pii(tables, c) if mask_pii else tables
    if keep_sample and not replay_run:
        for t, df in shown.items():
            key = c.primary_keys.get(t) or df.columns
            sinks.write_sample(first_n(df, key, keep_sample), out_base, dataset, t, run_id)
        if validate_sample:
            tables = {t: replay(spark, out_base, dataset, t, run_id) for t in tables}

    tag = f"{dataset}.{run_id}.replay" if replay_run else f"{dataset}.{run_id}"
    prof_path = sinks.write_json(profile_tables(tables), os.path.join(out_base, "profiles", tag)) if with_profile or suggest else None
    view_path = sinks.write_json(schema_view(spark, c.declared, tables), os.path.join(out_base, "metadata", f"{tag}.schema_view"))
    rep_path = sinks.write_json(validate(tables, c.checks, spark=spark), os.path.join(out_base, "sandbox", f"{tag}.report"))
    results = sinks.read_json(spark, rep_path, RESULT_DDL)
    ev_path = sinks.write_json(contract_evaluation(spark, c, results, tables),
                               os.path.join(out_base, "sandbox", f"{tag}.contract"))
    sum_path = sinks.write_json(with_overall(summary(results, c.checks)), os.path.join(out_base, "sandbox", f"{tag}.summary"))
    more = {}
    if suite:
        old = sinks.read_json(spark, sinks.write_json(validate(tables, suite, spark=spark), os.path.join(out_base, "sandbox", f"{tag}.suite")), RESULT_DDL)
        change = suite_change(old, results, rows_flipped(tables, suite, c.checks))
        more["suite_change"] = spark.read.json(sinks.write_json(change, os.path.join(out_base, "suite_change", tag)))
    if suggest:
        found = suggest_checks(tables, sinks.read_json(spark, prof_path, PROFILE_DDL))
        more["proposals"] = sinks.read_json(spark, sinks.write_json(found, os.path.join(out_base, "proposals", tag)), SUGGEST_DDL)
    if kept := retention_counts(tables, c, as_of):
        more["retention"] = spark.read.json(sinks.write_json(kept, os.path.join(out_base, "sandbox", f"{tag}.retention")))
    failed = failed_check_ids(results)
    fail_paths = {}
    for t, df in tables.items():
        chks = [k for k in c.checks if k.table == t and k.check_id in failed]
        if not chks:
            continue
        order = c.primary_keys.get(t) or df.columns
        rows = failing_rows(df, chks, order_by=order, n=failing_n, tables=tables)
        if mask_pii:
            from probity.functions.masking import mask_columns

            rows = mask_columns(rows, [x for x in c.pii.get(t, []) if x in rows.columns])
        fail_paths[t] = sinks.write_failing_csv(rows, os.path.join(out_base, "failing_examples", f"{tag}.{t}"))
    return {
        **({"profile": sinks.read_json(spark, prof_path, PROFILE_DDL)} if prof_path else {}),
        "schema_view": sinks.read_json(spark, view_path, SCHEMA_VIEW_DDL),
        "results": results,
        "evaluation": spark.read.json(ev_path),
        "summary": spark.read.json(sum_path),
        **more,
        **{f"failing:{t}": spark.read.option("header", True).csv(p) for t, p in fail_paths.items()},
    }
