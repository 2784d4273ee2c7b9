"""Column expressions shared by the models. All of them are built-in Catalyst functions."""
