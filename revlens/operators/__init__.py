"""Report operators: each is a function returning a lazy DataFrame."""
