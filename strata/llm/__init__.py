"""Operators for preparing training text: filters, dedup, decontamination,
packing, language-model scoring and sharding, plus the queries that apply
them to the ``documents`` table.  Nothing else in the library imports this
subpackage."""
