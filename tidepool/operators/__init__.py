"""Named operators, one module per area: frames, clean, network, text, terms,
score, rank, quality, taxa, patents, places, corpus, listings."""
