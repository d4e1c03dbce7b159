"""Scalar functions: Column builders, with Arrow UDFs only where Catalyst has no built-in."""
