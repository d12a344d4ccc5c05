from medallion.streaming.bulk import copy_into
from medallion.streaming.control import finish, stop_all_streams, wait_for_all_streams
from medallion.streaming.flows import Flow, new_rows, run_flow, run_flows, start_flow
from medallion.streaming.rules import Rule, apply_rules, rule_counts, rule_metrics

__all__ = [
    "Flow",
    "Rule",
    "apply_rules",
    "copy_into",
    "finish",
    "new_rows",
    "rule_counts",
    "rule_metrics",
    "run_flow",
    "run_flows",
    "start_flow",
    "stop_all_streams",
    "wait_for_all_streams",
]
