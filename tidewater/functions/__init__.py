"""Column-level building blocks (all JVM-side expressions, no Python UDFs)."""

from tidewater.functions.envelope import to_envelope, message_key, iso_timestamp  # noqa: F401
from tidewater.functions.parse import parse_messages, split_quarantine, is_quarantined  # noqa: F401
from tidewater.functions.scalar import (  # noqa: F401
    code_label, version_string, uri, normalize_vector, argmax,
)
