"""siftloom: profiling and cleaning of messy product tables on Spark."""

from .operators.roles import LOOSE_PATTERNS, STRICT_PATTERNS, detect_roles
from .plans.bundle import diagnose_stored
from .plans.clean import Cleaned, clean, clean_rows, write_counted
from .plans.diagnose import diagnose
from .plans.report import alerts, executive_metrics, issue_register
from .session import tune
from .settings import CODED, DEFAULT, Settings
from .sources.identity import number_rows
from .sources.scratch import remove_scratch
from .sources.tables import land_csv, read_csv, write_bundle, write_clean

__all__ = [
    "CODED", "Cleaned", "DEFAULT", "LOOSE_PATTERNS", "STRICT_PATTERNS", "Settings", "alerts", "clean", "clean_rows",
    "detect_roles", "diagnose", "diagnose_stored", "executive_metrics", "issue_register", "land_csv", "number_rows", "read_csv",
    "remove_scratch", "tune", "write_bundle", "write_clean", "write_counted",
]
