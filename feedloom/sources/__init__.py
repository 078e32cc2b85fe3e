"""Reading pages, feed files and the entry store; writing feeds and the store."""
