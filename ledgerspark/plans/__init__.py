"""Import plans, checkpoints and what is computed from them."""
