"""Load awkward landing files into tables, and show that the load is right."""
