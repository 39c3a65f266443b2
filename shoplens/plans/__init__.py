"""shoplens.plans."""
