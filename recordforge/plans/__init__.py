"""Queries of the record engine; importing the package registers them all."""

from . import edits, evidence, fields, healing, merging, records, review  # noqa: F401
from . import bound  # noqa: F401, I001  after the others: stated cases give way to queries over the tables
from . import flags  # noqa: F401, I001
