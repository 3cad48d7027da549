"""Plans: operators composed into runs that read and write the zones."""
