"""Plans: whole jobs and read queries composed from operators."""
