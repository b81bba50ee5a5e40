"""Whole tables, built from the operators."""

from .acts import act_tables, build_documents  # noqa: F401
from .analysis import analytic_star, bill_profile, complexity_table, growth_report  # noqa: F401
from .chamber import chamber_acts, chamber_coverage, chamber_signers, state_history  # noqa: F401
from .persons import registry_persons  # noqa: F401
from .senate import senate_bills, senate_coverage, senate_signers  # noqa: F401
