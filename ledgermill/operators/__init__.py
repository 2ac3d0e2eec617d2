"""DataFrame-to-DataFrame operators: cleaning, star-schema builders, keys, quality, audit."""
