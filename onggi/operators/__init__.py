"""DataFrame operators: filters, converters, preference, clustering, packing, blending, vocabularies, reports, statistics."""
