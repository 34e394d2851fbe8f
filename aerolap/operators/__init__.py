"""Row operators: filters, aggregates, top-k, reshaping, itineraries."""
