"""Columns built from columns: the scalar rules of the engine."""
