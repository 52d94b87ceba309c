"""Reading source tables, stamping them, and storing layers."""
