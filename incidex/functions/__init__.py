"""Column-level functions: every one returns a Spark ``Column`` built from
built-in expressions, so they stay inside whole-stage code generation."""

from .text import normalize_text, label_to_identifier, merge_labels  # noqa: F401
from .coords import repair_coordinate, coordinate_value, valid_coordinate  # noqa: F401
from .keys import row_fingerprint, entity_key, zone_year_sha256, zone_year_sha1  # noqa: F401
from .dates import day_with_default, assemble_date  # noqa: F401
