"""Writers: tables rendered to lines by expressions, then range-sorted and written as text."""
