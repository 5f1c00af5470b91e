"""Plans: the engine's stages, the registered queries and the SQL that checks them."""
