"""Training-data operators: each takes frames and returns frames; ``queries`` registers them."""
