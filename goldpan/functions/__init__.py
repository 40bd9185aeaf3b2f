"""Column expressions shared by the layers and the reports."""
