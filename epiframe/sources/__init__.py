"""Reading streams and episode datasets, and writing them."""
