"""Import every section so that its queries are registered."""

from catalog import columns, jobs, joins, machines, streams  # noqa: F401
