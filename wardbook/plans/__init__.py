"""The models, their tests, and the runs that build them."""
