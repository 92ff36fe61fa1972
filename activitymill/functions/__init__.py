"""Column functions shared by the builders."""
