from sedimenta.operators.lookups import attach
from sedimenta.operators.checks import Check, check_rows, run_checks
from sedimenta.operators.cleaning import CleanSpec, clean
from sedimenta.operators.summaries import Summary, grouped, grouped_before_attach, ordered, summarise

__all__ = [
    "Check",
    "CleanSpec",
    "Summary",
    "attach",
    "check_rows",
    "clean",
    "grouped",
    "grouped_before_attach",
    "ordered",
    "run_checks",
    "summarise",
]
