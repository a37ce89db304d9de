"""Readers (files, versioned folders, JDBC) and gates."""
