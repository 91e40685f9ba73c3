"""Reading corpora, titles, queries and books; writing listings."""
