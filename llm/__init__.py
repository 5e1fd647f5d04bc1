"""Training-data operators; nothing outside this package (and its registration) imports it."""
