"""Reports, profiles and the registered queries."""
