"""File sources, audit columns, file routing."""
