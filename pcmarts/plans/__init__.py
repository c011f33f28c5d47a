"""Silver tables, gold marts and the report library. Importing this package fills the catalog."""

from pcmarts.plans import extras, gold, silver  # noqa: F401
