"""Operators put together: tenant registry, canonical model, history flows, one refresh run."""
