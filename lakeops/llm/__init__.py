"""Operators for preparing training data: archives, extraction, dedup,
mixing, sharding, search, quality rules, packing and toxicity.

Nothing else in the library imports this subpackage. One module per
operator; ``queries`` registers the ``opN_<name>`` queries over the supplied
tables."""
