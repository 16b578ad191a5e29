"""Where data comes from: input trees, archives, lines."""
