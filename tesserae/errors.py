"""Errors that stop a build. Each has a fixed code; the message carries its context in sorted order."""

# The codes of the error taxonomy.
CODES = (
    "SOURCE_FETCH_FAILED", "SOURCE_SCHEMA_CHANGED", "LICENSE_REVIEW_REQUIRED", "ROW_COUNT_ANOMALY", "DUPLICATE_KEY_ANOMALY",
    "UNMATCHED_RATE_SPIKE", "AMBIGUOUS_RATE_SPIKE", "REQUIRED_SOURCE_MISSING", "CHECKSUM_MISMATCH", "VALIDATION_FAILED",
    "DATA_LOSS_SUSPECTED", "IDENTITY_COLLISION", "UNSAFE_ARCHIVE",
)


class BuildError(Exception):
    """A build that must not go on. ``code`` is one of ``CODES``."""

    def __init__(self, code: str, message: str, **context):
        if code not in CODES:
            raise ValueError(f"unknown error code {code}")
        self.code, self.context = code, context
        told = ", ".join(f"{k}={context[k]!r}" for k in sorted(context))
        super().__init__(f"{code}: {message}" + (f" [{told}]" if told else ""))


def stop_if_any(df, code: str, message: str, samples: int = 5):
    """Raise if ``df`` has rows, naming a few of them."""
    found = df.limit(samples).collect()
    if found:
        raise BuildError(code, message, samples=[r.asDict() for r in found])
