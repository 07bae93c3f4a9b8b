"""All oracle texts by query name."""

from oracles import baselines, experiments, marts, quality, reports

SQL: dict[str, str] = {
    **marts.SQL, **reports.SQL, **baselines.SQL, **experiments.SQL, **quality.SQL,
}
