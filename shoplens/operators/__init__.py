"""shoplens.operators."""
