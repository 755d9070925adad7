from checks.registry import ORACLES, QUERIES  # noqa: F401
# Importing a module registers its queries.
from checks import gold_checks, library_checks, merge_checks, payload_checks  # noqa: F401
