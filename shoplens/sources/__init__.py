"""shoplens.sources."""
